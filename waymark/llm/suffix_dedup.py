"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere are removed.

A full suffix array of a corpus is too large to ship, so the suffixes that are sorted are those at minimisers: of the
k-grams within each string of SPAN bytes the one with the least hash, which depends on the string alone. Equal strings
have equal minimisers at equal offsets, so nothing is missed. A suffix is sorted by two leading tokens: the k-gram at its
minimiser, and the whole stretch of text whose strings share that minimiser.

1. Sampled splitters range-partition the suffixes by their leading tokens. Buckets sort locally by multikey quicksort and
   compare neighbours: stretches equal to another one are repeated as a whole, k-grams seen once are not repeated.
2. What is left (equal k-grams within different stretches, and runs that reach a bucket's boundary) is compared across
   buckets string by string.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import keyed_once, lean, pinned, shuffles_dropped, written, zipped
from waymark.llm.prints import PART, Fingerprints

SPAN = 200
_SALT_FROM = 512  # suffixes of one k-gram that one task compares


def anchors(fp: Fingerprints, data: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """(token, stretch, lo, count) of the suffixes of a buffer of texts that end at ends.

    Strings start at lo .. lo + count - 1 and share a minimiser; token is its k-gram, stretch all text of these strings.
    """
    k = span // 2
    window = span - k + 1
    if len(data) < span:
        return (np.zeros(0, "u8"),) * 2 + (np.zeros(0, "i8"),) * 2
    sums = fp.sums(data)
    at = np.arange(len(data) - k + 1)
    grams = fp.of(sums, at, at + k)
    # the least high bits win, the last of equals; the low bits say where
    low = np.uint64((1 << 21) - 1)
    n = len(grams)
    rows = -(-n // window)
    key = np.full(rows * window, np.iinfo("u8").max, "u8")
    key[:n] = (grams & ~low) | (low - at.astype("u8"))
    grid = key.reshape(rows, window)
    before = np.minimum.accumulate(grid, 1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(after[: n - window + 1], before[window - 1 : n])
    spot = (low - (least & low)).astype("i8")
    start = np.arange(len(spot))
    end_of = np.repeat(ends, np.diff(ends, prepend=0))[: len(spot)]
    inside = start + span <= end_of
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (spot[1:] != spot[:-1])
    lo = np.flatnonzero(new)
    run = np.cumsum(new)[inside] - 1
    count = np.bincount(run, minlength=len(lo))
    token = grams[spot[lo]]
    stretch = fp.of(sums, lo, lo + count - 1 + span) ^ (count.astype("u8") * np.uint64(0xD6E8FEB86659FD93))
    return token, stretch, lo, count


def parts(bodies: list[bytes], span: int, part: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to buffers of about ``part`` bytes: (bytes, ends, index of each text, offset of its first byte).

    A longer text is cut with an overlap of span - 1 bytes, so that each string lies in one piece.
    """
    held: list[bytes] = []
    which: list[int] = []
    first: list[int] = []
    size = 0
    for i, body in enumerate(bodies):
        for at in range(0, max(1, len(body) - span + 1), part):
            piece = body[at : at + part + span - 1]
            if held and size + len(piece) > part + span:
                yield np.frombuffer(b"".join(held), "u1"), np.cumsum([len(x) for x in held]), np.array(which), np.array(first)
                held, which, first, size = [], [], [], 0
            held.append(piece)
            which.append(i)
            first.append(at)
            size += len(piece)
    if held:
        yield np.frombuffer(b"".join(held), "u1"), np.cumsum([len(x) for x in held]), np.array(which), np.array(first)


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Multikey quicksort, breadth first: sort by the leading tokens, then the runs of equals by the next ones."""
    order = np.argsort(columns[0], kind="stable")
    run = np.zeros(len(order), "i8")
    lead = columns[0][order]
    run[1:] = np.cumsum(lead[1:] != lead[:-1])
    for column in columns[1:]:
        size = np.bincount(run, minlength=1)
        open_ = np.flatnonzero(size[run] > 1)
        if not len(open_):
            break
        tie = np.lexsort((column[order[open_]], run[open_]))
        order[open_] = order[open_[tie]]
        value = column[order]
        step = run[1:] != run[:-1]
        run[1:] = np.cumsum(step | (value[1:] != value[:-1]))
    return order


_SUFFIX = "bucket int, token long, stretch long, row long, lo long, count int, multi boolean"
_FOUND = "token long, row long, lo long, count int, known boolean"


def _suffixes(span: int, splitters: np.ndarray | None, every: int = 1):
    """Suffixes of texts. Of equal ones in a batch one is sent with ``multi`` set; the others, bucket -1, are repeats already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp = Fingerprints()
        for b in batches:
            rows = np.asarray(b.column("row"))
            found = []
            for data, ends, which, first in parts([x.as_py() for x in b.column("body")], span):
                token, stretch, lo, count = anchors(fp, data, ends, span)
                text = np.searchsorted(ends, lo, side="right")
                starts = ends - np.diff(ends, prepend=0)
                found.append((token, stretch, rows[which[text]], lo - starts[text] + first[text], count))
            token, stretch, row, lo, count = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, "u8"),) * 2 + (np.zeros(0, "i8"),) * 3
            order = multikey_order([token, stretch])
            token, stretch, row, lo, count = token[order], stretch[order], row[order], lo[order], count[order]
            same = np.zeros(len(token), bool)
            same[1:] = (token[1:] == token[:-1]) & (stretch[1:] == stretch[:-1])
            multi = np.zeros(len(token), bool)
            multi[:-1] = same[1:]
            if splitters is None:
                keep = np.flatnonzero(~same)[::every]
                token, stretch, row, lo, count, same, multi = (x[keep] for x in (token, stretch, row, lo, count, same, multi))
                bucket = np.zeros(len(token), "i4")
            else:
                bucket = np.where(same, -1, np.searchsorted(splitters, _lead(token, stretch))).astype("i4")
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(token.view("i8")), pa.array(stretch.view("i8")), pa.array(row.astype("i8")), pa.array(lo.astype("i8")), pa.array(count.astype("i4")), pa.array(multi)], names=["bucket", "token", "stretch", "row", "lo", "count", "multi"])

    return run


def _lead(token: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """The leading tokens as one key: a token that fills several buckets is split by the second one."""
    return (token & ~np.uint64((1 << 20) - 1)) | (stretch >> np.uint64(44))


def _compare(splitters: np.ndarray):
    """Sort each bucket and compare neighbours. Emits repeats (known) and the suffixes still to be compared."""

    def resolve(bucket: int, cols: list[np.ndarray]) -> pa.RecordBatch:
        token, stretch, row, lo, count, multi = cols
        if bucket < 0:
            keep, known = np.ones(len(token), bool), np.ones(len(token), bool)
        else:
            order = multikey_order([token, stretch])
            token, stretch, row, lo, count, multi = (c[order] for c in (token, stretch, row, lo, count, multi))
            n = len(token)
            new_token, new_pair = np.ones(n, bool), np.ones(n, bool)
            new_token[1:] = token[1:] != token[:-1]
            new_pair[1:] = new_token[1:] | (stretch[1:] != stretch[:-1])
            of_pair, of_token = np.cumsum(new_pair) - 1, np.cumsum(new_token) - 1
            known = (np.bincount(of_pair)[of_pair] > 1) | (np.bincount(of_pair, multi)[of_pair] > 0)
            kinds = np.bincount(of_token, new_pair)
            edge = np.isin(token >> np.uint64(20), np.unique(splitters[max(0, bucket - 1) : bucket + 1] >> np.uint64(20)))
            open_ = (kinds[of_token] > 1) | edge
            keep = known | open_
            # one of each kind goes on; repeats are told apart from it by known
            ask = open_ & new_pair
            both = known & ask
            extra = np.flatnonzero(both)
            only_ask = ask & ~known
            token, row, lo, count, known = (np.concatenate([c[keep], c[extra]]) for c in (token, row, lo, count, known))
            flag = np.concatenate([(~only_ask)[keep], np.zeros(len(extra), bool)])
            return pa.RecordBatch.from_arrays([pa.array(token.view("i8")), pa.array(row), pa.array(lo), pa.array(count), pa.array(flag)], names=["token", "row", "lo", "count", "known"])
        return pa.RecordBatch.from_arrays([pa.array(token[keep].view("i8")), pa.array(row[keep]), pa.array(lo[keep]), pa.array(count[keep]), pa.array(known[keep])], names=["token", "row", "lo", "count", "known"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def columns() -> list[np.ndarray]:
            return [np.concatenate(c) for c in zip(*held, strict=True)]

        for b in batches:
            bucket = np.asarray(b.column("bucket"))
            cols = [np.asarray(b.column(n)) for n in ("token", "stretch", "row", "lo", "count")] + [b.column("multi").to_numpy(zero_copy_only=False)]
            cols[0], cols[1] = cols[0].view("u8"), cols[1].view("u8")
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for s, e in zip([0, *cut], [*cut, len(bucket)], strict=True):
                if s == e:
                    continue
                if held and bucket[s] != now or now == -1 and held:
                    yield resolve(now, columns())
                    held = []
                now = int(bucket[s])
                held.append([c[s:e] for c in cols])
        if held:
            yield resolve(now, columns())

    return run


def _strings(span: int):
    """Fingerprints of the strings asked for in each text: asked is an array of (token, lo, count, salts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp = Fingerprints()
        names = ["token", "salt", "row", "at", "prints"]
        for b in batches:
            out: dict[str, list] = {n: [] for n in names}
            held = 0
            for row, body, asked in zip(*(b.column(n).to_pylist() for n in ("row", "body", "asked")), strict=True):
                body = zlib.decompress(body)
                for q in asked:
                    data = np.frombuffer(body[q["lo"] : q["lo"] + q["count"] - 1 + span], "u1")
                    at = np.arange(q["count"])
                    prints = fp.of(fp.sums(data), at, at + span)
                    salt = (prints % np.uint64(q["salts"])).astype("i4")
                    for s in range(q["salts"]) if q["salts"] > 1 else (0,):
                        mine = salt == s
                        if not mine.any():
                            continue
                        for n, v in zip(names, (q["token"], s, row, (at[mine] + q["lo"]).astype("<i8").tobytes() if q["salts"] > 1 else np.int64(q["lo"]).tobytes(), prints[mine].tobytes()), strict=True):
                            out[n].append(v)
                        held += 8 * int(mine.sum())
                if held > 8 << 20:
                    yield _strings_batch(out)
                    out, held = {n: [] for n in names}, 0
            yield _strings_batch(out)

    return run


def _strings_batch(out: dict[str, list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of one (token, salt) at a time: the ones with equal fingerprints are repeats."""
    key, held = None, []

    def resolve() -> pa.RecordBatch:
        prints = [np.frombuffer(p, "u8") for _, _, p in held]
        at = [np.frombuffer(a, "<i8") if len(a) == len(p) and len(a) > 8 else np.frombuffer(a, "<i8")[0] + np.arange(len(p) // 8) for _, a, p in held]
        row = np.repeat([r for r, _, _ in held], [len(p) for p in prints])
        where = np.concatenate(at)
        _, kind, n = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
        found = n[kind] > 1
        row, where = row[found], where[found]
        order = np.lexsort((where, row))
        row, where = row[order], where[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (where[1:] != where[:-1] + 1)
        first = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays([pa.array(row[first].astype("i8")), pa.array(where[first].astype("i8")), pa.array(np.diff(np.append(first, len(row))).astype("i4"))], names=["row", "lo", "count"])

    for b in batches:
        for token, salt, row, at, prints in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (token, salt) != key and held:
                yield resolve()
                held = []
            key = token, salt
            held.append((row, at, prints))
    if held:
        yield resolve()


def repeats(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """(row, lo, count): starts lo .. lo + count - 1 of strings of span bytes that also start elsewhere; rows as from ``keyed_once``."""
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with shuffles_dropped(spark):  # else those of all jobs lie on disk until the driver collects its garbage
        bodies = rows.select("row", "body")
        # Splitters: quantiles of the suffixes of about 2,000 texts; only the balance of the buckets depends on them.
        share = max(1, rows.count() // 2000)
        sample = bodies.filter(F.abs(F.xxhash64("row")) % share == 0).mapInArrow(lean(_suffixes(span, None, 4)), _SUFFIX).select("token", "stretch").limit(200_000).toPandas()
        lead = np.sort(_lead(sample["token"].to_numpy("i8").view("u8"), sample["stretch"].to_numpy("i8").view("u8")))
        buckets = 4 * n
        splitters = np.unique(lead[np.linspace(0, len(lead) - 1, buckets + 1).astype("i8")[1:-1]]) if len(lead) > buckets else lead[:0]
        suffixes = bodies.mapInArrow(lean(_suffixes(span, splitters)), _SUFFIX)
        place = F.when(F.col("bucket") >= 0, F.xxhash64("bucket")).otherwise(F.xxhash64("row"))
        found = written(suffixes.repartition(n, place).sortWithinPartitions("bucket").mapInArrow(lean(_compare(splitters)), _FOUND))

        open_ = found.filter("not known")
        sizes = pinned(open_.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1"))
        asked = open_.join(sizes, "token").select("row", F.struct("token", "lo", "count", F.expr(f"cast(size div {_SALT_FROM} + 1 as int)").alias("salts")).alias("q")).groupBy("row").agg(F.collect_list("q").alias("asked"))
        strings = zipped(rows).drop("id").join(asked.hint("shuffle_hash"), "row").mapInArrow(lean(_strings(span)), "token long, salt int, row long, at binary, prints binary")
        met = written(strings.repartition(n, "token", "salt").sortWithinPartitions("token", "salt").mapInArrow(lean(_meet), "row long, lo long, count int"))
    return found.filter("known").select("row", "lo", "count").unionByName(met)


def cut(body: bytes, spans: list[tuple[int, int]], span: int) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the maximal removed runs (start, end); spans are (lo, count) of repeated starts."""
    runs: list[list[int]] = []
    for lo, count in sorted(spans):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], lo + count - 1 + span)
        else:
            runs.append([lo, lo + count - 1 + span])
    kept, at = [], 0
    for s, e in runs:
        kept.append(body[at:s])
        at = e
    kept.append(body[at:])
    return b"".join(kept), [(s, e) for s, e in runs]


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, with_text: bool = False) -> DataFrame:
    """row, doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept bytes, kept_text, spans), one row per row of docs.

    kept_text is the text of the kept bytes without the parts of characters that a cut leaves.

    Null text counts as empty; texts shorter than span lose nothing. Rows with equal ids are texts of their own. All
    copies of a repeated string go, the first one too.
    """
    rows = keyed_once(docs, doc_id, text)
    spans = repeats(rows, span).groupBy("row").agg(F.collect_list(F.struct("lo", "count")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "kept_text", "spans"] * with_text
        types = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.string(), pa.list_(pa.list_(pa.int64()))][: 4 if with_text else 1]
        for b in batches:
            out: list[list] = [[] for _ in names]
            for row, i, body, found in zip(*(b.column(n).to_pylist() for n in ("row", "id", "body", "spans")), strict=True):
                body = zlib.decompress(body)
                kept, runs = cut(body, [(s["lo"], s["count"]) for s in found or []], span)
                for c, v in zip(out, (row, i, len(body), len(body) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, kept.decode("utf-8", "ignore") if with_text else None, [list(r) for r in runs]), strict=False):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    schema = "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, kept_text string, spans array<array<long>>" * with_text
    return zipped(rows).join(spans.hint("shuffle_hash"), "row", "left").mapInArrow(lean(run), schema)
