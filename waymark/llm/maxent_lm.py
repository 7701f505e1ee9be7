"""Hashed maximum-entropy language model with a class-factored softmax.

P(token | history) = P(group | history) * P(class | group, history) * P(token | class). The first two factors are softmaxes over
16 groups and 16 classes of a group, with hashed weights for the previous token, the one before it (a skip feature) and both (a
trigram feature), which in the second factor are those of the group. The third is the maximum-entropy solution with a feature
for each token and a prior count of one: its share of the class. A token never seen in training is one event with the mass
that add-one smoothing leaves it, so that without context the model equals the smoothed unigrams.

Classes: the most frequent tokens have one each, the others go by their last two bytes; classes of like frequency form a group.
Counts cover all training text. The number of hashed weight rows grows with the square root of the vocabulary.
Weights are trained in rounds over disjoint slices that together cover all training text: each task runs mini-batch
gradient steps from the weights it was sent, and the weights move by the mean of the tasks' changes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import keyed, lean, written

FOLDS, OUT = 7, 2
SIDE = 16  # groups, and classes of a group
CLASSES = SIDE * SIDE
HEADS = 120
SUFFIXES = CLASSES - HEADS - 1
KNOWN = 300_000  # most tokens sent to every worker
ROUNDS = 3
_FIRST = 1 + SIDE  # rows of weights without context: of the groups, and of each group's classes
_NEVER = -1e4  # the logit of a class without tokens
_BATCH = 40_000  # tokens of a training step
_SLICE = 8_000  # rows of logits made in one go
END = b""


@dataclass
class Model:
    counts: dict[bytes, int]  # the most frequent tokens
    heads: dict[bytes, int]
    suffixes: dict[bytes, int]
    totals: np.ndarray  # of classes, with the prior count of each type
    tokens: int
    types: int
    weights: np.ndarray  # one row of SIDE logits for each feature, those without context first

    def class_of(self, word: bytes) -> int:
        c = self.heads.get(word)
        return self.suffixes.get(word[-2:], CLASSES - 1) if c is None else c


class _Codes(dict):
    """place << 40 | class << 32 | hash of each word met; place is one more than the word's number among the frequent tokens, or 0."""

    def __init__(self, model: Model):
        self.class_of, self.place = model.class_of, {w: k for k, w in enumerate(model.counts, 1)}

    def __missing__(self, w: bytes) -> int:
        code = self[w] = self.place.get(w, 0) << 40 | self.class_of(w) << 32 | zlib.crc32(w)
        return code


class _Reader:
    """Texts to arrays of places, classes and feature rows."""

    def __init__(self, model: Model, cache: int = 600_000):
        self.model, self.cache, self.known = model, cache, _Codes(model)

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.cache:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), "i8", len(words))

    def read(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, class, target[2], row[4, 2]) of the tokens of texts, each followed by its end: at 0 of the group, at 1 of the class in it."""
        flat: list[bytes] = []
        for t in texts:
            flat += t
        code = self.codes(flat)
        n = np.array([len(t) for t in texts])
        # two start marks before each text
        whole = np.full(len(code) + 2 * len(texts), -1, "i8")
        first = np.cumsum(n + 2) - n
        inside = np.ones(len(whole), bool)
        inside[first - 1] = inside[first - 2] = False
        whole[inside] = code
        at = np.flatnonzero(inside)
        h = whole.astype("u8") & np.uint64(0xFFFFFFFF)
        one, two = h[at - 1], h[at - 2]
        kind = (code >> 32 & 0xFF).astype("i4")
        target = np.stack([kind // SIDE, kind % SIDE])
        # What is predicted: 0 for the group, and 1 + group for the class.
        what = np.stack([np.zeros_like(kind), 1 + target[0]])
        mixed = what.astype("u8") * np.uint64(0xC2B2AE3D27D4EB4F)
        quarter = (len(self.model.weights) - _FIRST) // 4
        spread = lambda x, size, at: ((((x + mixed) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(36)) & np.uint64(size - 1)) + np.uint64(_FIRST + at)
        rows = np.stack([what.astype("u8"), spread(one, quarter, 0), spread(two, quarter, quarter), spread(one * np.uint64(31) + two + np.uint64(7), 2 * quarter, 2 * quarter)])
        return code >> 40, kind, target, rows.astype("i4")


def _log_softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        out += weights.take(r, axis=0)
    np.clip(out, -80, 60, out=out)  # so that no sum is zero or infinite; sums of short rows are slow but as a product
    out -= np.log(np.exp(out) @ np.ones((SIDE, 1), "f4"))
    return out


def _step(weights: np.ndarray, target: np.ndarray, rows: np.ndarray, rate: float) -> None:
    """One mini-batch gradient step; a row moves by its mean gradient, damped where it is rare."""
    n = len(target)
    p = np.empty((n, SIDE), "f4")
    for at in range(0, n, _SLICE):
        np.exp(_log_softmax(weights, rows[:, at : at + _SLICE]), out=p[at : at + _SLICE])
    p[np.arange(n), target] -= 1
    columns = np.ascontiguousarray(p.T, "f8")
    for r in rows:
        place = np.zeros(len(weights), "i4")
        place[r] = 1
        hit = np.flatnonzero(place)
        place[hit] = np.arange(len(hit))
        at = place[r]
        sums = np.stack([np.bincount(at, c) for c in columns], 1)
        weights[hit] -= (rate * sums / (np.bincount(at)[:, None] + 4)).astype("f4")


def _words(body: bytes) -> list[bytes]:
    words = body.lower().split()  # bytes: A-Z only, and white space as the contract names it
    words.append(END)
    return words


def _chunks(bodies: list[bytes], size: int = 2 * _BATCH) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Texts by groups of about ``size`` tokens: (index of the first, words)."""
    held, n, at = [], 0, 0
    for k, body in enumerate(bodies):
        held.append(_words(body))
        n += len(held[-1])
        if n >= size:
            yield at, held
            held, n, at = [], 0, k + 1
    if held:
        yield at, held


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c: Counter[bytes] = Counter()
        for body in b.column("body"):
            c.update(_words(body.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["token", "c"])


def _train(sent, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        reader, w, seen = _Reader(model), model.weights.copy(), 0
        for batch in batches:
            for _, texts in _chunks(batch.column("body").to_pylist(), _BATCH):
                _, kind, target, rows = reader.read(texts)
                for at in range(0, len(kind), _BATCH):
                    _step(w, target[:, at : at + _BATCH].ravel(), rows[:, :, at : at + _BATCH].reshape(len(rows), -1), rate)
                seen += len(kind)
        if seen:
            change = (w - model.weights).ravel() * np.float32(seen)
            parts = np.array_split(change, 8)
            yield pa.RecordBatch.from_arrays([pa.array(range(8), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([seen] * 8, pa.int64())], names=["part", "change", "seen"])

    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the changes of each part."""
    total: dict[int, list] = {}
    for b in batches:
        for part, change, seen in zip(*(c.to_pylist() for c in b.columns), strict=True):
            x = np.frombuffer(change, "f4")
            if part in total:
                total[part][0] += x
                total[part][1] += seen
            else:
                total[part] = [x.astype("f8"), seen]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t[0].tobytes() for t in total.values()], pa.binary()), pa.array([t[1] for t in total.values()], pa.int64())], names=["part", "change", "seen"])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, out: int = OUT, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model and the table of counts (token, c), learnt from rows outside fold ``out``. Without such rows nothing is known."""
    fold = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")))
    train = keyed(docs, doc_id, text).filter(fold % folds != out)
    counts = written(train.select("body").mapInArrow(lean(_count), "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")))
    tokens, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # The least count of which at most KNOWN tokens have as many: from a histogram by eighths of powers of two.
    eighth = F.floor(F.log2("c") * 8)
    steps = sorted(((r.e, r.n) for r in counts.groupBy(eighth.alias("e")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, held = None, 0
    for e, n in steps:
        held += n
        if held > KNOWN:
            break
        least = e
    top = counts.filter(eighth >= least).toArrow() if least is not None else None
    known = dict(zip(top["token"].to_pylist(), top["c"].to_pylist(), strict=True)) if top is not None else {}
    del top
    ordered = sorted(known, key=lambda w: (-known[w], w))
    heads = {w: k for k, w in enumerate(ordered[:HEADS])}
    # Totals by last two bytes: 65,793 rows at most.
    ends = {bytes(r.s): r.c for r in counts.groupBy(F.expr("substring(token, -2, 2)").alias("s")).agg(F.sum(F.col("c") + 1).alias("c")).collect()}
    for w in heads:
        ends[w[-2:]] -= known[w] + 1
    suffixes = {s: HEADS + k for k, s in enumerate(sorted(ends, key=lambda s: (-ends[s], s))[:SUFFIXES])}
    totals = np.zeros(CLASSES)
    for w, k in heads.items():
        totals[k] += known[w] + 1
    for s, c in ends.items():
        totals[suffixes.get(s, CLASSES - 1)] += c
    weights = np.zeros((_FIRST + (1 << max(10, round(np.log2(types + 1) / 2) + 5)), SIDE), "f4")
    each = totals.reshape(SIDE, SIDE)
    first = np.vstack([each.sum(1), each])
    weights[:_FIRST] = np.where(first > 0, np.log(np.maximum(first, 1) / np.maximum(first.sum(1, keepdims=True), 1)), _NEVER)
    model = Model(known, heads, suffixes, totals, tokens, types, weights)
    for k in range(rounds if tokens else 0):
        sent = docs.sparkSession.sparkContext.broadcast(Model({}, heads, suffixes, totals, tokens, types, model.weights))  # grows with the root of the vocabulary
        part = train.filter((fold / folds).cast("long") % rounds == k).select("body")
        moved = part.mapInArrow(lean(_train(sent, 0.6)), "part int, change binary, seen long").repartition(8, "part").mapInArrow(lean(_sum), "part int, change binary, seen long").collect()
        if moved:
            mean = np.concatenate([np.frombuffer(r.change, "f8") / r.seen for r in sorted(moved, key=lambda r: r.part)]).astype("f4")
            model.weights = model.weights + mean.reshape(model.weights.shape)
    return model, counts


def _scored(sent):
    """Rows (key, row, id, n, known, base, score, kind): sums over a text's frequent tokens (n of them is all), and a row for
    each other token (kind: its class), to be completed by its count. Keys that start with a space match no token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        reader = _Reader(model)
        c = np.append(np.fromiter(model.counts.values(), "f8", len(model.counts)), np.nan)
        base_of = np.log10((c + 1) / (model.tokens + model.types + 1))
        seen = np.log10((model.tokens + model.types) / (model.tokens + model.types + 1)) if model.tokens else 0.0
        share = np.log10(np.maximum(model.totals, 1))
        own = np.log10(c + 1)
        for b in batches:
            ids, row_of = b.column("id").to_pylist(), b.column("row").to_pylist()
            for at, texts in _chunks(b.column("body").to_pylist()):
                where, kind, target, rows = reader.read(texts)
                logp = np.empty(len(kind))
                for s in range(0, len(kind), _SLICE // 2):
                    aim = target[:, s : s + _SLICE // 2]
                    x = _log_softmax(model.weights, rows[:, :, s : s + _SLICE // 2].reshape(len(rows), -1))
                    logp[s : s + _SLICE // 2] = x[np.arange(len(x)), aim.ravel()].reshape(aim.shape).sum(0, dtype="f8") / np.log(10)
                logp += seen - share[kind]
                where -= 1
                frequent = where >= 0
                text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
                n = np.bincount(text, minlength=len(texts))
                known = np.bincount(text, frequent, len(texts))
                base = np.bincount(text, np.where(frequent, base_of[where], 0), len(texts))
                score = np.bincount(text, np.where(frequent, logp + own[where], 0), len(texts))
                keys = [b" %d" % row_of[at + k] for k in range(len(texts))]
                out = [keys, row_of[at : at + len(texts)], ids[at : at + len(texts)], n, known.astype("i8"), base, score, np.full(len(texts), -1)]
                rare: dict[tuple[int, bytes], list] = {}
                first = np.cumsum(n) - n
                for k in np.flatnonzero(~frequent).tolist():
                    t = int(text[k])
                    r = rare.setdefault((t, texts[t][k - int(first[t])]), [0, 0.0])
                    r[0] += 1
                    r[1] += logp[k]
                more = [[w for _, w in rare], [row_of[at + t] for t, _ in rare], [ids[at + t] for t, _ in rare], [r[0] for r in rare.values()], [0] * len(rare), [0.0] * len(rare), [r[1] for r in rare.values()], [0] * len(rare)]
                types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32())
                names = ["token", "row", "id", "n", "known", "base", "score", "kind"]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(more, types, strict=True)], names=names)

    return run


def score(docs: DataFrame, model: Model, counts: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, out: int = OUT) -> DataFrame:
    """row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    Null and empty texts are one end. Null ids count as empty text for their fold.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # KNOWN tokens, and weights
    got = keyed(docs, doc_id, text).mapInArrow(lean(_scored(sent)), "token binary, row long, id long, n long, known long, base double, score double, kind int")
    least = min(model.counts.values(), default=None)
    tail = counts if least is None else counts.filter(F.col("c") < least)
    total = float(model.tokens + model.types + 1)
    unseen = float(-np.log10(total))
    rare, c = F.col("kind") >= 0, F.coalesce("c", F.lit(0))
    full = got.join(tail, "token", "left").select(
        "row", "id",
        F.when(rare, F.lit(0)).otherwise(F.col("n")).alias("n"),
        F.when(rare, F.when(c > 0, F.col("n")).otherwise(0)).otherwise(F.col("known")).alias("known"),
        F.when(rare, F.col("n") * F.log10((c + 1) / F.lit(total))).otherwise(F.col("base")).alias("base"),
        F.when(~rare, F.col("score")).when(c > 0, F.col("score") + F.col("n") * F.log10(c + 1)).otherwise(F.col("n") * F.lit(unseen)).alias("score"),
    )
    fold = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")))
    return full.groupBy("row").agg(F.max("id").alias("id"), F.sum("n").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score")).select(
        "row", F.col("id").alias("doc_id"), (fold % folds == out).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
