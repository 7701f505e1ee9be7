"""N-gram Jaccard join in the metric space of word shingle sets.

1. Equal sets are one node. Two sets within the threshold share a shingle of their prefixes under any fixed order of
   shingles (the most frequent come last here), so the least document of each prefix shingle serves as a pivot, and the
   documents that hold that shingle form its region. A pair within the threshold meets in the region of its first common
   shingle. The places of that shingle in both sets bound what the sets can share: a region's documents are peers, which
   may link with any, or fringe, which may link with peers only. So texts of one template that differ in a rare word are
   all fringe and are compared with none of their kind.
2. A document carries a parity sketch: bit i says whether it has an odd number of shingles that hash to i. The Hamming
   distance of two sketches is a metric and never exceeds the symmetric difference of the sets, so it bounds the Jaccard
   distance from below and obeys the triangle inequality. Regions above a size are dealt to cells with a few pivots in
   each; a minimum spanning forest of the pairs that sketches don't rule out is verified on whole sets. That joins the ball
   of a pivot, however large, to one component.
3. Where a region's documents aren't in one component then, those outside its largest one are compared with the region:
   many of them are divided into Voronoi regions of pivots drawn from them, by bands of set size. A document also visits the
   regions whose pivot is at most twice the threshold farther than its nearest one, and within the region's radius plus
   the threshold. Regions are divided again as long as that halves the work, then compared block by block, exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import Tables, keyed_once, lean, pinned, shuffles_dropped, zipped
from waymark.llm.components import components
from waymark.llm.prints import WordHashes

WORDS, NUM, DEN = 5, 75, 100
_HEAVY_SHARE, _HEAVY_FROM, _HEAVY_MOST = 32, 8, 100_000
_CELL, _PIVOTS = 256, 8
_BLOCK = 8192  # documents on either side that the last step compares in one go
_BROADCAST = 500_000  # most row numbers
_MANY = 20_000  # pairs of one block; of more the nearest ones come first
_LEVELS = 4  # divisions of a region at most
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], "u8")


class Shingler:
    """Sorted different 64-bit shingle hashes of texts; nothing is kept from one text to the next."""

    def __init__(self, words: int = WORDS):
        self.words, self.hashes = words, WordHashes()

    def sets(self, bodies: Iterable[bytes]) -> Iterator[np.ndarray]:
        for h in self.hashes.of(bodies):
            n = len(h) - self.words + 1
            if not len(h):
                yield h
                continue
            if n < 1:  # the whole sequence, told apart by its length
                n, k = 1, len(h)
                s = np.array([k], "u8") * _MULTIPLIERS[7]
            else:
                k, s = self.words, np.zeros(n, "u8")
            for i in range(k):
                s = s + h[i : i + n] * _MULTIPLIERS[i]
            s = (s ^ (s >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            yield np.unique(s ^ (s >> np.uint64(29)))

    def __call__(self, body: bytes) -> np.ndarray:
        return next(self.sets([body]))


def sketch(s: np.ndarray) -> bytes:
    """Parity sketch of a set, of a power of two of bits: two to four for each shingle, 64 at least."""
    bits = 1 << max(6, int(2 * len(s) - 1).bit_length())
    # the low bits of the place stay as a sketch is folded
    place = (s * np.uint64(0x9FB21C651E98DF25)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(place.astype("i8"), minlength=bits) & 1).astype("u1").tobytes()


def fold(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of the same set with fewer bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, "u1").reshape(-1, size), axis=0)


def prefix_size(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def _nodes(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for b in batches:
            out: list[list] = [[], [], []]
            for s in shingles.sets(b.column("body").to_pylist()):
                for c, v in zip(out, (len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, sketch(s) if len(s) else None), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.binary(), pa.binary()), strict=True))], names=["row", "id", "n", "digest", "sketch"])

    return run


def _sampled(words: int):
    """Shingles of a sample of documents with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for b in batches:
            found = list(shingles.sets(b.column("body").to_pylist()))
            s, n = np.unique(np.concatenate(found) if found else np.zeros(0, "u8"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(s.view("i8")), pa.array(n)], names=["shingle", "n"])

    return run


def ordered_prefix(s: np.ndarray, num: int, den: int, heavy: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, which of it are heavy) of a set: shingles by hash, then the heavy ones, the most frequent last."""
    n = prefix_size(len(s), num, den)
    if not len(heavy):
        return s[:n], np.zeros(min(n, len(s)), bool)
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
    often = heavy[at] == s
    last = s[often][np.argsort(rank[at[often]], kind="stable")]
    light = len(s) - len(last)
    return np.concatenate([s[~often], last])[:n], np.arange(min(n, len(s))) >= light


def _prefixes(words: int, num: int, den: int, heavy: np.ndarray, rank: np.ndarray):
    """(shingle, salt, row, at): prefix shingles of each different set of a batch; salt is -1 for shingles that aren't heavy."""

    def batch(out: list, heavies: list, rows: list, places: list) -> Iterator[pa.RecordBatch]:
        s, often, row, at = (np.concatenate(x) for x in (out, heavies, rows, places))
        yield pa.RecordBatch.from_arrays([pa.array(s.view("i8")), pa.array(np.where(often, row % 64, -1).astype("i4")), pa.array(row), pa.array(at)], names=["shingle", "salt", "row", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for b in batches:
            seen, held, size = set(), ([], [], [], []), 0
            for row, s in zip(b.column("row").to_pylist(), shingles.sets(b.column("body").to_pylist()), strict=True):
                if not len(s) or (d := xxhash.xxh3_128_digest(s.tobytes())) in seen:
                    continue
                seen.add(d)
                s, often = ordered_prefix(s, num, den, heavy, rank)
                for c, v in zip(held, (s, often, np.full(len(s), row, "i8"), np.arange(len(s), dtype="i4")), strict=True):
                    c.append(v)
                size += len(s)
                if size > 300_000:
                    yield from batch(*held)
                    held, size = ([], [], [], []), 0
            if size:
                yield from batch(*held)

    return run


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, pivot, row, at): the least row of each (shingle, salt) of a sorted partition, for the others; shingle 0 unless salted."""
    held: list[np.ndarray] = []
    size, key, pivot = 0, None, 0

    def flush() -> pa.RecordBatch:
        got = np.concatenate(held, 1) if held else np.zeros((4, 0), "i8")
        got = got[:, np.lexsort(got[::-1])]
        got = got[:, np.append(True, (got[:3, 1:] != got[:3, :-1]).any(0))] if got.shape[1] else got
        return pa.RecordBatch.from_arrays([pa.array(c) for c in got], names=["shingle", "pivot", "row", "at"])

    for b in batches:
        shingle, salt, row, at = (np.asarray(b.column(c)) for c in ("shingle", "salt", "row", "at"))
        if not len(row):
            continue
        new = np.ones(len(row), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1])
        new[0] = (shingle[0], salt[0]) != key
        first = np.where(new, row, 0)
        if not new[0]:
            first[0] = pivot
        starts = np.flatnonzero(new | (np.arange(len(row)) == 0))
        pivots = first[starts][np.cumsum(new | (np.arange(len(row)) == 0)) - 1]
        key, pivot = (shingle[-1], salt[-1]), pivots[-1]
        keep = (pivots != row) | (salt >= 0)
        if keep.any():
            held.append(np.stack([np.where(salt >= 0, shingle, 0)[keep], pivots[keep], row[keep], at[keep].astype("i8")]))
            size += int(keep.sum())
        if size > 500_000:
            yield flush()
            held, size = [], 0
    yield flush()


class _Cell:
    """Documents with their sketches, and the pairs that neither these nor the places of the common shingle rule out."""

    def __init__(self, n: list[int], at: list[int], sketches: list[bytes], num: int, den: int):
        self.n, self.at, self.num, self.den = np.array(n, "i8"), np.array(at, "i8"), num, den
        self.bytes = np.array([len(s) for s in sketches])
        self.folds: dict[int, np.ndarray] = {}
        for size in sorted(set(self.bytes.tolist())):
            folded = np.zeros((len(n), size), "u1")
            for k, s in enumerate(sketches):
                if len(s) >= size:
                    folded[k] = fold(s, size)
            self.folds[size] = folded

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, distance) of the pairs of left x right that may be within the threshold; distance is that of the sketches."""
        out = []
        n_right, left_right = self.n[right], self.n[right] - self.at[right]
        for i in left.tolist():
            mine, n = int(self.bytes[i]), int(self.n[i])
            shared = np.minimum(left_right, n - int(self.at[i]))  # no more can be common
            js = right[((self.den + self.num) * shared >= self.num * (n_right + n)) & (right != i)]
            for size in np.unique(np.minimum(self.bytes[js], mine)).tolist():
                at = js[np.minimum(self.bytes[js], mine) == size]
                folded = self.folds[size]
                gap = np.bitwise_count(folded[at] ^ folded[i]).sum(1, dtype="i8")
                ok = gap * (self.den + self.num) <= (self.n[at] + n) * (self.den - self.num)
                out.append(np.stack([np.full(int(ok.sum()), i), at[ok], (gap[ok] << 20) // (self.n[at][ok] + n)]))
        return tuple(np.concatenate(out, 1)) if out else (np.zeros(0, "i8"),) * 3


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a minimum spanning forest."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k in np.lexsort((j, i, weight)).tolist():
        a, b = root(int(i[k])), root(int(j[k]))
        if a != b:
            parent[a] = b
            out.append((int(i[k]), int(j[k])))
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Columns of each run of equal keys of a sorted partition."""
    now, held = None, {}
    for b in batches:
        names = b.schema.names
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            row = dict(zip(names, r, strict=True))
            key = tuple(row[k] for k in keys)
            if key != now:
                if held:
                    yield held
                now, held = key, {n: [] for n in names}
            for n in names:
                held[n].append(row[n])
    if held:
        yield held


def _pairs_batch(out: list[tuple[int, int]], region: int | None = None) -> pa.RecordBatch:
    cols = [pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)]
    if region is None:
        return pa.RecordBatch.from_arrays(cols, names=["a", "b"])
    return pa.RecordBatch.from_arrays([*cols, pa.array([region] * len(out), pa.int64())], names=["a", "b", "region"])


def _best(left: np.ndarray, group: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Places of the pair with the least gap of each (left, group)."""
    order = np.lexsort((gap, group, left))
    new = np.ones(len(order), bool)
    new[1:] = (left[order][1:] != left[order][:-1]) | (group[order][1:] != group[order][:-1])
    return order[new]


def _trees(num: int, den: int):
    """Forests of the cells of a first pass; every pair within the threshold has a peer in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["region", "cell"]):
            if len(g["node"]) > 1:
                cell = _Cell(g["n"], g["at"], g["sketch"], num, den)
                every = np.arange(len(g["node"]))
                yield _pairs_batch([(g["node"][a], g["node"][b]) for a, b in _forest(*cell.pairs(np.flatnonzero(g["peer"]), every), len(every))], g["region"][0])

    return run


def _crossing(num: int, den: int, best: bool):
    """Pairs of an outsider and a document of another component. With ``best`` the nearest one of each component, and the
    others too unless they are very many; a pair (-1, -1) says that others are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["region", "block", "cell"]):
            out = np.array(g["outside"], bool)
            outside, inside = np.flatnonzero(out), np.flatnonzero(~out)
            if len(outside) and len(inside):
                cell = _Cell(g["n"], g["at"], g["sketch"], num, den)
                root, node = np.array(g["root"]), np.array(g["node"])
                i, j, gap = cell.pairs(outside, inside)
                cross = root[i] != root[j]
                i, j, gap = i[cross], j[cross], gap[cross]
                cut = best and len(i) > _MANY
                if cut:
                    one = _best(i, root[j], gap)
                    i, j = i[one], j[one]
                yield _pairs_batch(list(zip(node[i].tolist(), node[j].tolist(), strict=True)) + [(-1, -1)] * cut)

    return run


def _distances(num: int, den: int):
    """(region, node, pivot, far, near, test): sketch distance of each document of a cell to the region's pivots, all folded to the
    region's shortest sketch; ``near`` is the least of them, ``test`` says that the pair isn't ruled out and may join two components."""
    names = ["region", "node", "pivot", "far", "near", "test"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["region", "cell"]):
            is_pivot = np.array(g["pivot"], bool)
            pivots, others = np.flatnonzero(is_pivot), np.flatnonzero(~is_pivot)
            if not len(pivots) or not len(others):
                continue
            folded = np.stack([fold(s, g["short"][0]) for s in g["sketch"]])
            far = np.stack([np.bitwise_count(folded[others] ^ folded[p]).sum(1, dtype="i8") for p in pivots], 1)
            cell = _Cell(g["n"], g["at"], g["sketch"], num, den)
            test = np.zeros((len(g["node"]), len(g["node"])), bool)
            i, j, _ = cell.pairs(pivots, others)
            test[j, i] = True
            root, node = np.array(g["root"]), np.array(g["node"])
            test = test[np.ix_(others, pivots)] & (root[others][:, None] != root[pivots][None, :])
            k = len(pivots)
            cols = [np.full(far.size, g["region"][0]), np.repeat(node[others], k), np.tile(node[pivots], len(others)), far.ravel(), np.repeat(far.min(1), k), test.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    return run


def _verified(words: int, num: int, den: int):
    """Pairs (a, b) whose sets are within the threshold; both texts of a pair come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for g in _groups(batches, ["a", "b"]):
            if len(g["body"]) == 2:
                x, y = (shingles(zlib.decompress(t)) for t in g["body"])
                both = len(np.intersect1d(x, y, assume_unique=True))
                if den * both >= num * (len(x) + len(y) - both):
                    yield _pairs_batch([(g["a"][0], g["b"][0])])

    return run


def _few(df: DataFrame) -> DataFrame:
    """df, a row of numbers for each region, pinned; broadcast as long as its rows are few, else hashed."""
    df = pinned(df)
    return F.broadcast(df) if df.count() <= _BROADCAST else df.hint("shuffle_hash")


class _Search:
    """Links between the components that a first pass left in the same region."""

    def __init__(self, num: int, den: int, parts: int, tables: Tables):
        self.num, self.den, self.parts, self.tables = num, den, parts, tables

    def reach(self, n: str) -> Column:
        """The largest symmetric difference that a set of n may have to one it links with."""
        return F.expr(f"(({n} + ({n} * {self.den}) div {self.num}) * {self.den - self.num}) div {self.den + self.num}")

    def crossing(self, active: DataFrame, best: bool) -> DataFrame:
        """Candidate pairs (a, b) of the owners and the inside of each region, block by block of owners."""
        sizes = _few(active.groupBy("region").agg(F.expr(f"cast((count_if(inside) - 1) div {_BLOCK} + 1 as int)").alias("cells"), F.expr(f"cast((count_if(owner) - 1) div {_BLOCK} + 1 as int)").alias("blocks"), F.expr("bool_or(owner) and bool_or(inside)").alias("both")).filter("both").drop("both"))
        dealt = active.join(sizes, "region").withColumns({"own_cell": F.expr("cast(abs(xxhash64(node)) % cells as int)"), "own_block": F.expr("cast(abs(xxhash64(node, 1)) % blocks as int)")})
        columns = ["region", "node", "n", "at", "sketch", "root"]
        inside = dealt.filter("inside").select(*columns, F.col("own_cell").alias("cell"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(False).alias("outside"))
        outside = dealt.filter("owner").select(*columns, F.explode(F.expr("sequence(0, cells - 1)")).alias("cell"), F.col("own_block").alias("block"), F.lit(True).alias("outside"))
        met = inside.unionByName(outside).repartition(self.parts, "region", "block", "cell").sortWithinPartitions("region", "block", "cell", "outside", "node")
        return met.mapInArrow(lean(_crossing(self.num, self.den, best)), "a long, b long")

    def banded(self, active: DataFrame) -> DataFrame:
        """Regions by bands of set size: an owner lies in its own band, the inside also in the bands of sizes it may link with."""
        band = F.floor(F.log("n") / float(np.log(self.den / self.num))).cast("int")
        each = active.withColumn("band", band).withColumn("at_band", F.explode(F.expr("if(inside, sequence(band - 1, band + 1), array(band))")))
        return each.select(F.xxhash64("region", "at_band").alias("region"), "node", "n", "at", "sketch", "root", (F.col("owner") & (F.col("band") == F.col("at_band"))).alias("owner"), "inside")

    def divide(self, active: DataFrame, level: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(regions that stay whole, Voronoi regions of the others, pairs with pivots that aren't ruled out)."""
        seed = F.xxhash64("node", "region", F.lit(level))
        stats = active.groupBy("region").agg(F.count_if("inside").alias("size"), F.count_if("owner").alias("owners"), F.min(F.length("sketch")).alias("short"), F.expr("min_by(node, xxhash64(node)) filter (where owner)").alias("one"))
        large = pinned(stats.filter(f"owners > {_BLOCK} and size > {_BLOCK}"))
        whole = active.join(stats.filter(f"owners > 0 and size > 0 and not (owners > {_BLOCK} and size > {_BLOCK})").select("region"), "region", "left_semi")
        if large.isEmpty():
            return whole, active.filter("false"), whole.select(F.col("node").alias("a"), F.col("node").alias("b")).filter("false")
        dealt = active.join(large, "region").withColumn("cells", F.expr(f"cast((size - 1) div {_CELL} + 1 as int)"))
        dealt = dealt.withColumn("chosen", (F.col("node") == F.col("one")) | (F.col("owner") & (F.abs(seed) % F.col("owners") < 2 * _PIVOTS)))
        columns = ["region", "node", "n", "at", "sketch", "root", "short"]
        members = dealt.select(*columns, F.expr("cast(abs(xxhash64(node)) % cells as int)").alias("cell"), F.lit(False).alias("pivot"))
        pivots = dealt.filter("chosen").select(*columns, F.explode(F.expr("sequence(0, cells - 1)")).alias("cell"), F.lit(True).alias("pivot"))
        met = members.unionByName(pivots).repartition(self.parts, "region", "cell").sortWithinPartitions("region", "cell", "pivot", "node")
        far = self.tables.written(met.mapInArrow(lean(_distances(self.num, self.den)), "region long, node long, pivot long, far long, near long, test boolean"))
        tested = far.filter("test").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        # A pivot has met its whole region: it owns nothing any more. Of pivots at the same distance the least one owns a document.
        pivot_of = dealt.filter("chosen").select("region", "node", F.lit(True).alias("met"))
        info = dealt.select("region", "node", "n", "owner", "inside").join(pivot_of, ["region", "node"], "left")
        owned = far.filter("far = near").groupBy("region", "node").agg(F.min("pivot").alias("home"))
        seen = far.join(info, ["region", "node"]).join(owned, ["region", "node"]).withColumn("owns", F.col("owner") & F.col("met").isNull() & (F.col("pivot") == F.col("home")))
        radius = pinned(seen.filter("owns").groupBy("region", "pivot").agg(F.max("far").alias("radius")))
        near = seen.join(radius, ["region", "pivot"]).filter((F.col("far") <= F.col("near") + 2 * self.reach("n")) & (F.col("far") <= F.col("radius") + self.reach("n")))
        near = self.tables.written(near.select("region", "pivot", "node", "owns", "inside").filter("owns or inside"))
        work = near.groupBy("region", "pivot").agg(F.count_if("inside").cast("double").alias("size"), F.count_if("owns").alias("owners")).groupBy("region").agg(F.sum(F.col("size") * F.col("owners")).alias("work"))
        better = pinned(large.join(work, "region", "left").select("region", (F.coalesce("work", F.lit(0.0)) * 2 <= F.col("size").cast("double") * F.col("owners")).alias("better")))
        rows = dealt.select("region", "node", "n", "at", "sketch", "root")
        parts = near.join(better.filter("better"), "region", "left_semi").join(rows, ["region", "node"]).select(F.xxhash64("region", "pivot").alias("region"), "node", "n", "at", "sketch", "root", F.col("owns").alias("owner"), "inside")
        same = active.join(better.filter("not better"), "region", "left_semi")
        return whole.unionByName(same), parts, tested


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """row, doc_id, n_shingles, component_id, root: one row per row of docs.

    Documents link when den * |intersection| >= num * |union| of their sets of word shingles. component_id is the least
    doc_id reachable by links, itself included (null ids don't count; a component of null ids has null). A text without
    words has no shingle and no link. Rows that repeat are linked like others. root is a row of the component and tells
    components apart, which component_id doesn't where ids repeat or are null. An empty table gives no rows; other columns
    of docs are not read.
    """
    with shuffles_dropped(docs.sparkSession):
        joined, names = _joined(docs, doc_id, text, words, num, den)
    return joined.join(names, "root").select("row", F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "root")


def _joined(docs: DataFrame, doc_id: str, text: str, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(row, id, n, root) of each row, and the component_id of each root."""
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tables = Tables()
    rows = keyed_once(docs, doc_id, text, tables)
    bodies = rows.select("row", "body")
    nodes = tables.written(rows.mapInArrow(lean(_nodes(words)), "row long, id long, n long, digest binary, sketch binary"))
    some = nodes.filter("n > 0")
    reps = pinned(some.groupBy("digest").agg(F.min("row").alias("node")))
    wordless = nodes.filter("n = 0").select("row", "id", "n", F.col("row").alias("node"))
    of_row = tables.written(some.select("row", "id", "n", "digest").join(reps, "digest").select("row", "id", "n", "node").unionByName(wordless))
    set_of = nodes.select(F.col("row").alias("node"), "n", "sketch").join(reps.select("node"), "node", "left_semi")

    # Which shingles come last in the order: any choice is right, a good one keeps regions small. At most _HEAVY_MOST.
    sample = bodies.filter(F.abs(F.xxhash64("row")) % _HEAVY_SHARE == 0).mapInArrow(lean(_sampled(words)), "shingle long, n long")
    often = sample.groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= _HEAVY_FROM).orderBy(F.desc("n"), "shingle").limit(_HEAVY_MOST).toArrow()
    heavy, count = often["shingle"].to_numpy().astype("i8").view("u8"), often["n"].to_numpy()
    order = np.argsort(heavy)
    rank = np.empty(len(heavy), "i8")
    rank[np.lexsort((heavy, count))] = np.arange(len(heavy))

    held = bodies.mapInArrow(lean(_prefixes(words, num, den, heavy[order], rank[order])), "shingle long, salt int, row long, at int")
    found = tables.written(held.repartition(n, "shingle", "salt").sortWithinPartitions("shingle", "salt", "row").mapInArrow(lean(_regions), "shingle long, pivot long, row long, at long"))
    salted = found.filter("shingle <> 0")
    least = salted.groupBy("shingle").agg(F.min("pivot").alias("least"))  # a row for each heavy shingle at most
    member = found.filter("shingle = 0").select("pivot", "row", "at").unionByName(salted.join(F.broadcast(least), "shingle").select(F.col("least").alias("pivot"), "row", "at"))
    member = member.groupBy("pivot", "row").agg(F.min("at").alias("at"))
    node_of = of_row.select("row", "node")
    member = member.join(node_of, "row").select("pivot", "at", F.col("node").alias("other")).join(node_of.select(F.col("row").alias("pivot"), F.col("node").alias("region")), "pivot").filter("other <> region")
    # A region's pivot is a member of its own; its first shingle may be the common one.
    regions = tables.written(member.select("region", F.col("other").alias("node"), "at").unionByName(member.select("region", F.col("region").alias("node"), F.lit(0).cast("long").alias("at")).distinct()).groupBy("region", "node").agg(F.min("at").alias("at")))
    tables.drop(found)
    # The largest set that the places of the common shingle allow; a peer may link with sets of its own size or larger ones.
    peer = F.expr(f"({den + num} * (n - at)) div {num} - n >= n")
    placed = tables.written(regions.join(set_of, "node").select("region", "node", "n", "at", "sketch", peer.alias("peer")))
    tables.drop(regions, nodes)
    sizes = pinned(placed.groupBy("region").agg(F.count("*").alias("size")).filter(f"size > {_CELL}"))
    members = placed.join(sizes, "region", "left").select("region", "node", "n", "at", "sketch", "peer", F.expr(f"cast(coalesce((size - 1) div {_CELL} + 1, 1) as int)").alias("cells"))
    home = F.expr("cast(abs(xxhash64(node)) % cells as int)")
    columns = ["region", "node", "n", "at", "sketch", "peer"]
    own = members.select(*columns, home.alias("cell"))
    # Pivots of a large region: its own and a few other peers, in every other cell too.
    shared = members.filter(f"cells > 1 and peer and (node = region or abs(xxhash64(node, region)) % (cells * {_CELL}) < {_PIVOTS})").select(*columns, home.alias("home"), F.explode(F.expr("sequence(0, cells - 1)")).alias("cell"))
    dealt = own.unionByName(shared.filter("cell <> home").drop("home"))
    trees = dealt.repartition(n, "region", "cell").sortWithinPartitions("region", "cell", "node").mapInArrow(lean(_trees(num, den)), "a long, b long, region long")
    tree = pinned(trees.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "region"))
    asked = pinned(tree.select("a", "b").distinct())

    def verify(pairs: DataFrame) -> DataFrame:
        """Links among pairs. Only texts that sketches couldn't rule out are shuffled."""
        sides = pinned(pairs.select("a", "b", F.explode(F.array("a", "b")).alias("row")))
        wanted = pinned(sides.select("row").distinct())
        # Row numbers alone are broadcast, as long as they are few.
        wanted = F.broadcast(wanted) if wanted.count() <= _BROADCAST else wanted.hint("shuffle_hash")
        texts = zipped(rows.join(wanted, "row", "left_semi")).select("row", "body")
        return pinned(sides.join(texts, "row").select("a", "b", "row", "body").repartition(n, "a", "b").sortWithinPartitions("a", "b", "row").mapInArrow(lean(_verified(words, num, den)), "a long, b long"))

    links = verify(asked)
    roots = components(links)
    # Where a region is one cell and all edges of its forest are links, no pair that isn't ruled out joins two components;
    # so only regions with a failed edge or with several cells come again.
    failed = tree.join(links, ["a", "b"], "left_anti").select("region")
    again = failed.unionByName(sizes.select("region")).distinct()
    active = pinned(placed.join(_few(again), "region", "left_semi"))
    tables.drop(placed)
    if not active.isEmpty():
        roots = _between(_Search(num, den, n, tables), active, asked, roots, verify)

    joined = pinned(of_row.join(roots, "node", "left").select("row", "id", "n", F.coalesce("root", "node").alias("root")))
    names = pinned(joined.groupBy("root").agg(F.min("id").alias("component_id")))
    tables.drop()
    return joined, names


def _between(search: _Search, active: DataFrame, asked: DataFrame, roots: DataFrame, verify) -> DataFrame:
    """Roots after links between the components within the regions of active(region, node, n, at, sketch, peer)."""
    leaves = None
    for best in (True, False):
        if leaves is None:
            leaves, tested = _divided(search, active, roots)
        candidates = search.crossing(leaves, best)
        for p in tested:
            candidates = candidates.unionByName(p)
        found = pinned(candidates.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        left = not found.filter("a < 0").isEmpty()
        found = found.filter("a >= 0")
        more = pinned(found.join(asked, ["a", "b"], "left_anti"))
        links = verify(more) if not more.isEmpty() else more
        # All pairs were tested, or the nearest one of each component, which is enough where it is a link.
        done = not left or found.join(links, ["a", "b"], "left_anti").isEmpty()
        if not links.isEmpty():
            roots, leaves = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)), None
        if done:
            break
        asked = asked.unionByName(more)
    return roots


def _divided(search: _Search, active: DataFrame, roots: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Regions to be searched for links between their components, and pairs with pivots that are to be tested."""
    labelled = pinned(active.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    counts = labelled.groupBy("region", "root").agg(F.count("*").alias("size"))
    main = _few(counts.groupBy("region").agg(F.max(F.struct("size", F.col("root"))).alias("m"), F.count("*").alias("kinds")).filter("kinds > 1").select("region", F.col("m.root").alias("main")))
    apart = labelled.join(main, "region").withColumn("apart", F.col("root") != F.col("main")).drop("main")
    # Outsiders that are peers against all, and those that are fringe against the peers.
    now = apart.select("*", F.expr("apart and peer").alias("owner"), F.lit(True).alias("inside")).unionByName(apart.filter("apart or peer").withColumn("region", F.xxhash64("region", F.lit("fringe"))).select("*", F.expr("apart and not peer").alias("owner"), F.col("peer").alias("inside"))).drop("apart", "peer")
    # Regions with many of both go by bands of size, then by Voronoi regions.
    # Most regions have owners in one of their two parts only; a part without owners, or without others, has no pair.
    both = pinned(now.groupBy("region").agg(F.count_if("owner").alias("k"), F.count_if("inside").alias("size")).filter("k > 0 and size > 0"))
    is_many = f"k > {_BLOCK} and size > {_BLOCK}"
    many = pinned(both.filter(is_many).select("region"))
    leaves, pairs = now.join(_few(both.filter(f"not ({is_many})").select("region")), "region", "left_semi"), []
    if not many.isEmpty():
        rest = pinned(search.banded(now.join(many, "region", "left_semi")))
        for level in range(_LEVELS):
            whole, parts, tested = search.divide(rest, level)
            leaves, rest = leaves.unionByName(pinned(whole)), pinned(parts)
            pairs.append(tested)
            if rest.isEmpty():
                break
        leaves = leaves.unionByName(rest)
    return pinned(leaves), pairs
