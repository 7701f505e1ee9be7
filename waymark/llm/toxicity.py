"""Toxicity by non-negative positive-unlabelled learning.

A linear numpy classifier over words and their openings is fitted on confirmed toxic texts and unlabelled ones. The risk is
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)); where the bracket falls below zero, the step goes
back along it. Every training text is unlabelled data: tasks take mini-batch gradient steps over their shard of sparse rows
from the weights they were sent, and the weights move to the mean of the tasks' weights. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import Tables, keyed, lean, small_batches, text_bytes
from waymark.llm.prints import PART, WordHashes

#: Documented bounds of the fit: confirmed toxic texts (labelled rows), features that may be chosen, chosen features.
MAX_POSITIVE, MAX_CANDIDATES, MAX_FEATURES = 2500, 32_768, 2048
#: Rows of a shard, of a mini-batch; rounds, passes over a shard in a round, least steps of a round.
SHARD, BATCH, ROUNDS, PASSES, LEAST_STEPS = 20_000, 2048, 3, 8, 150
FOLDS = 5
_NO_WORD = bytes(c for c in range(128) if not chr(c).isalpha())
_OPENINGS = (4, 5, 6)


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id's decimal text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


class Features:
    """Hashes of the words of texts and of their first 4, 5 and 6 bytes. Words are runs of ASCII letters and of bytes beyond."""

    def __init__(self):
        self.hashes = WordHashes(_NO_WORD)

    def __call__(self, bodies: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the text, feature), a buffer of texts at a time; a word beyond the buffer, which comes alone, is hashed whole."""
        for index, held in self.hashes.groups(bodies):
            if len(held[0]) > PART:
                word = held[0].lower()
                yield np.array(index * 4), np.array([xxhash.xxh3_64_intdigest(word) ^ 1, *(self._opening(word[:n]) for n in _OPENINGS)], "u8")
                continue
            data, sums, start, end, text = self.hashes.spots(held)
            found, whose = [self.hashes.words(data, sums, start, end) ^ np.uint64(1)], [text]
            for n in _OPENINGS:
                long = end - start >= n
                found.append(self.hashes.prints.of(sums, start[long], start[long] + n))
                whose.append(text[long])
            yield np.array(index)[np.concatenate(whose)], np.concatenate(found)

    def _opening(self, start: bytes) -> int:
        sums = self.hashes.prints.sums(np.frombuffer(start, "u1"))
        return int(self.hashes.prints.of(sums, np.array([0]), np.array([len(start)]))[0])


class Matcher:
    """Of the features of texts those in a sorted array."""

    def __init__(self, features: np.ndarray):
        self.features, self.of = features, Features()

    def __call__(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the text, place of the feature), each pair once, in order."""
        keys = [np.zeros(0, "i8")]
        if len(self.features):
            for text, f in self.of(bodies):
                place = np.minimum(np.searchsorted(self.features, f), len(self.features) - 1)
                hit = self.features[place] == f
                keys.append(np.unique(text[hit] << 16 | place[hit]))
        key = np.unique(np.concatenate(keys))
        return key >> 16, key & 0xFFFF


class Rows:
    """Sparse rows of zeros and ones: the features of row k are those from start[k] to start[k + 1]."""

    def __init__(self, rows: list[np.ndarray], size: int):
        self.at = np.concatenate([*rows, np.zeros(0, "i8")]).astype("i8")
        self.count, self.size = np.array([len(r) for r in rows], "i8"), size
        self.start = np.concatenate([[0], np.cumsum(self.count)])

    def some(self, rows: np.ndarray) -> Rows:
        out = Rows([], self.size)
        out.count = self.count[rows]
        out.start = np.concatenate([[0], np.cumsum(out.count)])
        out.at = self.at[np.arange(out.start[-1]) + np.repeat(self.start[rows] - out.start[:-1], out.count)]
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(w[self.at])])
        return total[self.start[1:]] - total[self.start[:-1]]

    def back(self, c: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, np.repeat(c, self.count), self.size)


def fit_nnpu(positive: Rows, unlabelled: Rows, prior: float, w: np.ndarray, b: float, steps: int, rate: float = 0.05, l2: float = 1e-3, batch: int = BATCH, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias after mini-batch steps from w and b."""
    rng = np.random.default_rng(seed)
    w, n = w.copy(), len(unlabelled.count)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    order, xu = np.zeros(0, "i8"), unlabelled
    every, xp = positive, positive
    for step in range(1, steps + 1):
        if n > batch:
            if len(order) < batch:
                order = rng.permutation(n)
            xu, order = unlabelled.some(order[:batch]), order[batch:]
        if len(every.count) > batch // 4:
            xp = every.some(rng.choice(len(every.count), batch // 4, replace=False))
        gp, gu = xp.dot(w) + b, xu.dot(w) + b
        # logistic loss: l+(g) = log(1 + e^-g), l-(g) = log(1 + e^g)
        below = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        dp, du = sigmoid(gp), sigmoid(gu)
        up = (prior / len(gp)) * (dp - 1)
        minus_p, minus_u = (-prior / len(gp)) * dp, du / len(gu)
        cp, cu = (up + minus_p, minus_u) if below >= 0 else (-minus_p, -minus_u)
        grad = np.append(xp.back(cp) + xu.back(cu) + l2 * w, cp.sum() + cu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


class ToxicityModel:
    """Feature weights; ``weights`` maps feature hashes to their weights."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias

    def scorer(self):
        """A function of texts; the weights of a text are summed in the order of their features."""
        features = np.array(sorted(self.weights), "u8")
        match, w = Matcher(features), np.array([self.weights[int(f)] for f in features])

        def score(bodies: list[bytes]) -> np.ndarray:
            text, place = match(bodies)
            return 1 / (1 + np.exp(-np.clip(self.bias + np.bincount(text, w[place], len(bodies)), -60, 60)))

        return score


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, f): the different features of each text."""
    of = Features()
    for b in batches:
        bodies, out = b.column("body").to_pylist(), []
        for body in bodies:
            out.append(np.unique(np.concatenate([f for _, f in of([body])] or [np.zeros(0, "u8")])).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.binary())], names=["id", "f"])


def _matched(sent):
    """(id, f): places of the candidate features of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(sent.value)
        for b in batches:
            text, place = match(b.column("body").to_pylist())
            out = np.split(place.astype("<u2"), np.searchsorted(text, np.arange(1, b.num_rows)))[: b.num_rows]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([x.tobytes() for x in out], pa.binary())], names=["id", "f"])

    return run


def _counted(size: int):
    """One row for each task: texts, and how many of them hold each candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, "i8")
        for b in batches:
            n += b.num_rows
            total += np.bincount(np.frombuffer(b"".join(b.column("f").to_pylist()), "<u2"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["at", "n"])

    return run


def _steps(sent, size: int, prior: float):
    """One row for each shard: its texts, and the weights after its steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positive, w, b, round_ = sent.value
        now, held = None, []

        def done() -> pa.RecordBatch:
            rows = Rows(held, size)
            steps = max(LEAST_STEPS, PASSES * (-(-len(held) // BATCH)))
            w1, b1 = fit_nnpu(Rows(positive, size), rows, prior, w, b, steps, rate=0.05 / (1 + round_), seed=now)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([len(held)], pa.int64()), pa.array([np.append(w1, b1).astype("<f8").tobytes()], pa.binary())], names=["shard", "n", "w"])

        for batch in batches:
            for shard, f in zip(batch.column("shard").to_pylist(), batch.column("f").to_pylist(), strict=True):
                if shard != now and held:
                    yield done()
                    held = []
                now = shard
                held.append(np.frombuffer(f, "<u2"))
        if held:
            yield done()

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of n and of n * w of a partition."""
    n, total = 0, None
    for b in batches:
        for k, w in zip(b.column("n").to_pylist(), b.column("w").to_pylist(), strict=True):
            n, total = n + k, k * np.frombuffer(w, "<f8") + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "w"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = FOLDS, max_positive: int = MAX_POSITIVE) -> ToxicityModel:
    """Fit on rows outside fold 0: at most max_positive confirmed toxic texts, and all texts as unlabelled ones.

    The class prior is the share of toxic rows among all labelled rows outside fold 0. Confirmed texts are those with the
    smallest hashes of their ids, shards are dealt by ids, so that they are the same in every run. Rows with null ids and
    null labels are left out. Without a confirmed toxic text, or without a text of another kind, every text scores 0.
    """
    spark, tables = docs.sparkSession, Tables()
    own = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("id").isNotNull() & F.col("y").isNotNull() & (fold(F.col("id"), folds) != 0))
    prior = own.agg(F.avg((F.col("y") == 1).cast("double"))).first()[0] or 0.0
    none = ToxicityModel({}, -60.0)
    if not 0 < prior < 1:
        return none
    rows = keyed(docs, doc_id, text).filter(F.col("id").isNotNull() & (fold(F.col("id"), folds) != 0)).select("id", "body")
    # At most max_positive ids are broadcast, as many rows come back.
    ids = own.filter("y = 1").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(max_positive)
    got = rows.join(F.broadcast(ids), "id").mapInArrow(lean(_features), "id long, f binary").orderBy(F.xxhash64("id"), "id", "f").limit(max_positive).select("f").toArrow()
    p = [np.frombuffer(f, "u8") for f in got["f"].to_pylist()]
    if not p:
        return none
    found, in_p = np.unique(np.concatenate(p), return_counts=True)
    often = np.flatnonzero(in_p >= max(3, len(p) // 500))
    often = np.sort(often[np.argsort(-in_p[often], kind="stable")[:MAX_CANDIDATES]])
    if not len(often):
        return none
    candidates, in_p = found[often], in_p[often]
    matched = tables.written(rows.mapInArrow(lean(_matched(spark.sparkContext.broadcast(candidates))), "id long, f binary"))
    counts = {r.at: r.n for r in matched.mapInArrow(lean(_counted(len(candidates))), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}  # a row for each candidate at most
    n = counts.pop(-1, 0)
    if n <= len(p):
        tables.drop()
        return none
    in_u = np.array([counts.get(k, 0) for k in range(len(candidates))])
    rate_p, rate_u = (in_p + 0.5) / (len(p) + 1), (in_u + 0.5) / (n + 1)
    gain = np.where(rate_p > 2 * rate_u, in_p * np.log(rate_p / rate_u), 0)
    chosen = np.argsort(-gain, kind="stable")[:MAX_FEATURES]
    chosen = np.sort(chosen[gain[chosen] > 0])
    if not len(chosen):
        tables.drop()
        return none
    place = np.full(len(candidates), -1)
    place[chosen] = np.arange(len(chosen))

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for f in b.column("f").to_pylist():
                k = place[np.frombuffer(f, "<u2")]
                out.append(k[k >= 0].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("id"), pa.array(out, pa.binary())], names=["shard", "id", "f"])

    shards = n // SHARD + 1
    sharded = matched.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), "id", "f").mapInArrow(lean(narrowed), "shard long, id long, f binary")
    parts = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sharded = tables.written(sharded.repartition(parts, "shard").sortWithinPartitions("shard", "id", "f").select("shard", "f"))
    positive = []
    for x in p:
        k = place[np.minimum(np.searchsorted(candidates, x), len(candidates) - 1)]
        positive.append(k[(k >= 0) & np.isin(x, candidates)])
    w, b = np.zeros(len(chosen)), 0.0
    for round_ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((positive, w, b, round_))
        moved = sharded.mapInArrow(lean(_steps(sent, len(chosen), prior)), "shard long, n long, w binary").repartition(8, "shard").mapInArrow(lean(_mean), "n long, w binary").collect()
        mean = sum(np.frombuffer(r.w, "<f8") for r in moved) / sum(r.n for r in moved)
        w, b = mean[:-1], float(mean[-1])
    tables.drop()
    return ToxicityModel({int(i): float(v) for i, v in zip(candidates[chosen], w, strict=True)}, b)


def score_column(model: ToxicityModel, text: Column) -> Column:
    """The score of a text (null counts as empty) as a column, so that a filter by it moves no row."""
    sent = SparkContext.getOrCreate().broadcast(model)  # at most MAX_FEATURES weights

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = sent.value.scorer()
        for bodies in batches:
            yield pa.array(score(bodies.to_pylist()), pa.float64())

    return run(text)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs, in its order. Empty and null texts score the bias alone."""
    small_batches(docs.sparkSession)
    got = docs.select(F.col(doc_id).cast("long").alias("doc_id"), score_column(model, text_bytes(text)).alias("score"))
    return got.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Rows of docs, with all their columns, whose text scores below one half."""
    small_batches(docs.sparkSession)
    return docs.filter(score_column(model, text_bytes(text)) < 0.5)
