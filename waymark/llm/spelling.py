"""Spelling variants: words at one edit of each other, found in a trie of letter counts.

A word is a path: its length, then how often it has the letters of each group, group after group. An edit adds one letter to
one group (insertion), takes one from one group (deletion), or does both (replacement, within one group also neither). So a
depth-first search that may spend a surplus of one and a deficit of one reaches the leaves of all words that are near, and
only words in those leaves are compared letter by letter.

The length and the first groups are the top of the trie and deal its subtrees out over the cluster; each word is sent to
the few subtrees that its budget can reach, and the search goes on there. A pair is found from one side only: from the
shorter word, or from the one whose first differing group is the smaller one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import Tables, keyed, lean, pinned

LEAST_LETTERS, LEAST_COUNT, RATIO, SLIP = 6, 5, 5, 199
GROUPS, ALONE, TOP = 16, 12, 4  # groups of letters; those of a single letter; levels that deal out subtrees
_SUBTREE = 1 << 20  # bytes of words in one block of a subtree
_LEAF = 16
_HELD = 150_000  # words that a task counts before it sends them on
#: What a search may still spend: both, the deficit, the surplus, nothing.
BOTH, DEFICIT, SURPLUS, NOTHING = range(4)


def runs(text: str, least: int) -> list[str]:
    """Maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF with at least so many of them, A-Z lower-cased."""
    return re.findall("[a-zÀ-ÿ]{%d,}" % least, text)


def _counter(least: int, slip: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        crc = zlib.crc32
        for b in batches:
            for i, body in zip(b.column("id").to_pylist(), b.column("body"), strict=True):
                start = crc(b"%d:" % i if i is not None else b":")
                # bytes.lower() touches A-Z only
                for w, n in Counter(runs(body.as_py().lower().decode("utf-8", "replace"), least)).items():
                    h = crc(w.encode(), start)
                    if not h % slip:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < least:
                            continue
                    held[w] = held.get(w, 0) + n
                if len(held) > _HELD:
                    yield flush()
        yield flush()

    return count


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """word, n: runs of letters that occur often enough, after one letter of about every slip-th run of a document went.

    A run shorter than least_letters can't become a word, so it is skipped. Null texts have no runs; a null id counts as an
    empty one.
    """
    found = keyed(docs, doc_id, text).mapInArrow(lean(_counter(least_letters, slip)), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_groups(table: DataFrame) -> np.ndarray:
    """Group of each of the 256 letters: the most common ones have a group each, the rest share what is left.

    At most 90 rows come to the driver, one for each letter of the alphabet.
    """
    seen = table.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().filter("c <> ''").collect()
    groups = np.full(256, GROUPS - 1, "u1")
    for rank, r in enumerate(sorted(seen, key=lambda r: (-r["count"], r.c))):
        groups[ord(r.c)] = rank if rank < ALONE else ALONE + rank % (GROUPS - ALONE)
    return groups


def vectors(letters: np.ndarray, ends: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Counts of each word's letters by group. letters: all words' letters on end."""
    word = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return np.bincount(word * GROUPS + groups[letters], minlength=len(ends) * GROUPS).reshape(-1, GROUPS).astype("i4")


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(texts).encode("latin-1"), "u1"), np.cumsum([len(t) for t in texts])


def reachable(paths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(which words, the subtree's path, what may still be spent) of all subtrees that near words can be in.

    paths: length and counts of the first groups. Only one side of each pair looks for the other one.
    """
    every = np.arange(len(paths))
    top = range(1, paths.shape[1])
    yield every, paths, BOTH
    longer = paths.copy()
    longer[:, 0] += 1
    yield every, longer, SURPLUS
    for i in top:
        for base, left in ((paths, DEFICIT), (longer, NOTHING)):
            more = base.copy()
            more[:, i] += 1
            yield every, more, left
        for j in range(i + 1, paths.shape[1]):
            some = np.flatnonzero(paths[:, j])
            both = paths[some]
            both[:, i] += 1
            both[:, j] -= 1
            yield some, both, NOTHING


_SENT = pa.schema([("subtree", pa.binary()), ("budget", pa.int8()), ("word", pa.string()), ("n", pa.int64())])


def _paths(b: pa.RecordBatch, groups: np.ndarray) -> np.ndarray:
    letters, ends = joined(b.column("word").to_pylist())
    return np.column_stack([np.diff(ends, prepend=0), vectors(letters, ends, groups)[:, :TOP]]).astype("<i4")


def _keys(paths: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(paths, "<i4")
    return pa.array([row.tobytes() for row in flat], pa.binary())


def _members(groups: np.ndarray):
    """Each word in its own subtree, with the budget -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([_keys(_paths(b, groups)), pa.array(np.full(b.num_rows, -1, "i1")), b.column("word"), b.column("n")], schema=_SENT)

    return run


def _searches(groups: np.ndarray):
    """Each word once for each subtree that it is looked for in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                for some, paths, left in reachable(_paths(b, groups)):
                    take = pa.array(some)
                    yield pa.RecordBatch.from_arrays([_keys(paths), pa.array(np.full(len(some), left, "i1")), b.column("word").take(take), b.column("n").take(take)], schema=_SENT)

    return run


class Subtree:
    """Words of one length and one top, sorted by their letter counts: a range of rows is a node of the trie."""

    def __init__(self, texts: list[str], counts: list[int], groups: np.ndarray):
        letters, ends = joined(texts)
        vector = vectors(letters, ends, groups)
        order = np.lexsort(vector.T[::-1])
        self.groups, self.vector = groups, vector[order].astype("i2")
        self.texts, self.n = [texts[k] for k in order], [counts[k] for k in order]
        self.letters = letters.reshape(len(texts), -1)[order]

    def search(self, texts: list[str], budget: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of texts, rows of the subtree) of words that are one edit apart. All texts are equally long."""
        letters, ends = joined(texts)
        self.asked, self.asked_letters = vectors(letters, ends, self.groups).astype("i2"), letters.reshape(len(texts), -1)
        yield from self._down(0, len(self.texts), TOP, np.arange(len(texts)), budget)

    def _down(self, lo: int, hi: int, level: int, who: np.ndarray, budget: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if hi - lo <= _LEAF or level == GROUPS:
            yield from self._leaf(lo, hi, level, who, budget)
            return
        column, own = self.vector[lo:hi, level], self.asked[who, level]
        ends = [*(np.flatnonzero(np.diff(column)) + 1 + lo).tolist(), hi]
        for begin, end in zip([lo, *ends[:-1]], ends, strict=True):
            more = self.vector[begin, level] - own
            plus, minus = (more == 1) & ((budget == BOTH) | (budget == SURPLUS)), (more == -1) & (budget == DEFICIT)
            on = np.flatnonzero((more == 0) | plus | minus)
            if len(on):
                left = np.where(plus, np.where(budget == BOTH, DEFICIT, NOTHING), np.where(minus, NOTHING, budget))
                yield from self._down(begin, end, level + 1, who[on], left[on])

    def _leaf(self, lo: int, hi: int, level: int, who: np.ndarray, budget: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        width = (hi - lo) * max(GROUPS - level, 1)
        step = max(1, (1 << 21) // width)
        for at in range(0, len(who), step):
            some, left = who[at : at + step], budget[at : at + step, None]
            more = self.vector[None, lo:hi, level:] - self.asked[some][:, None, level:]
            # Lengths and tops fix the sum of what is left, so surplus and deficit need not be told apart here.
            within = np.abs(more).sum(2) <= np.array([2, 1, 1, 0])[left]
            a, b = np.nonzero(within)
            if len(a):
                # Of two words that differ in two groups, the one that has less in the first of them looks for the other.
                pick = more[a, b]
                moved = pick.any(1)
                first = np.take_along_axis(pick, (pick != 0).argmax(1)[:, None], 1)[:, 0] if level < GROUPS else np.zeros(len(a))
                keep = (left[a, 0] != BOTH) | ~moved | (first > 0)
                yield from self._verified(some[a[keep]], b[keep] + lo, left[a[keep], 0])

    def _verified(self, a: np.ndarray, b: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        own, other = self.asked_letters.shape[1], self.letters.shape[1]
        step = max(1, (1 << 22) // other)
        for at in range(0, len(a), step):
            i, j = a[at : at + step], b[at : at + step]
            x, y = self.asked_letters[i], self.letters[j]
            if own == other:
                near = (x != y).sum(1) == 1
                # Equal counts: both words meet each other here, so the smaller one speaks.
                differ = (x != y).argmax(1)[:, None]
                level = (self.asked[i] == self.vector[j]).all(1)
                near &= ~level | (np.take_along_axis(x, differ, 1) < np.take_along_axis(y, differ, 1))[:, 0]
            else:
                # With y one letter longer: equal up to the first difference, and from there on with y moved by one.
                early = np.cumprod(x == y[:, :own], 1).sum(1)
                late = np.cumprod((x == y[:, 1:])[:, ::-1], 1).sum(1)
                near = early + late >= own
            if near.any():
                yield i[near], j[near]


_FOUND = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string()), ("other_n", pa.int64())])


def _walk(groups: np.ndarray):
    """Searches of each subtree's block; its words come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, texts, counts = None, None, [], []
        for b in batches:
            cols = b.to_pydict()
            asks: dict[int, list[tuple[int, str, int]]] = {}

            def answer():
                for own in asks.values():
                    asked, n = [w for _, w, _ in own], [m for _, _, m in own]
                    for i, j in tree.search(asked, np.array([x for x, _, _ in own])):
                        a, b_ = [asked[k] for k in i], [tree.texts[k] for k in j]
                        na, nb = [n[k] for k in i], [tree.n[k] for k in j]
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((a + b_, na + nb, b_ + a, nb + na), _FOUND, strict=True)], schema=_FOUND)
                asks.clear()

            for subtree, block, budget, word, n in zip(cols["subtree"], cols["block"], cols["budget"], cols["word"], cols["n"], strict=True):
                if (subtree, block) != key:
                    yield from answer()
                    key, tree, texts, counts = (subtree, block), None, [], []
                if budget < 0:
                    texts.append(word)
                    counts.append(n)
                elif texts:
                    tree = tree or Subtree(texts, counts, groups)
                    asks.setdefault(len(word), []).append((budget, word, n))
            yield from answer()

    return run


def near_words(table: DataFrame) -> DataFrame:
    """word, n, other, other_n: both directions of each pair of words in (word, n) that are one edit apart.

    Words have letters up to U+00FF. A subtree of more than 1 MB of words is cut into blocks, and its searches go to each of
    them; at most one subtree for each MB of words is that large, so their list is small enough to be broadcast.
    """
    groups = letter_groups(table)
    kind = "subtree binary, budget byte, word string, n long"
    members = table.select("word", "n").mapInArrow(lean(_members(groups)), kind)
    large = members.groupBy("subtree").agg(F.ceil(F.sum(F.length("word")) / _SUBTREE).cast("int").alias("blocks")).filter("blocks > 1")
    large = F.broadcast(pinned(large))
    blocks = F.coalesce("blocks", F.lit(1))
    own = members.join(large, "subtree", "left").withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int")).drop("blocks")
    asks = table.select("word", "n").mapInArrow(lean(_searches(groups)), kind)
    asks = asks.join(large, "subtree", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks")
    both = own.unionByName(asks).repartition("subtree", "block").sortWithinPartitions("subtree", "block", "budget")
    return both.mapInArrow(lean(_walk(groups)), "word string, n long, other string, other_n long")


def roots(links: DataFrame) -> DataFrame:
    """word, root of (word, form): forms are followed to the last, twice as far in each round."""
    now = pinned(links.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = pinned(now.join(on, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")))
        now = step.drop("_moved")
        if step.filter("_moved").isEmpty():
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO, slip: int = SLIP) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of docs.

    A word's form is its near word of the largest n (of equal ones the smallest in code-point order) if that is at least
    ratio times the word's own, else null; root is the last form on the way from it, or the word itself. n grows on that way,
    so it ends. Null, empty and very long texts, repeated rows and null ids count as in ``words``; rows that repeat count each
    time. An empty table gives no words. Other columns of docs are not read.
    """
    tables = Tables()
    table = tables.written(words(docs, doc_id, text, least_letters, least_count, slip))
    near = near_words(table)
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))).alias("best")
    every = table.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n")).unionByName(near)
    chosen = (-F.col("best.n")) >= F.col("n") * ratio
    told = every.groupBy("word").agg(F.first("n").alias("n"), F.count("other").alias("n_near"), best).select("word", "n", "n_near", F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.n")).alias("form_n"))
    told = pinned(told)
    tables.drop()
    ends = roots(told.filter("form is not null"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
