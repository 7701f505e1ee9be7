"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson.

The covariance is never formed. Each product with a few vectors is one pass over the distinct vectors: every task centres
its rows, multiplies twice and sends one partial sum. On the driver live only vectors as long as one embedding. An outer
step takes the Ritz pairs of the subspace, and MINRES solves their correction equations, projected against what is known,
all columns in one pass; pairs are locked, leading ones first, when their residual is rounding error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import Tables, lean, small_batches

SCALE = 256
_ROWS = 4096  # distinct vectors in one stored block, fewer where they are long
_BLOCK = 4 << 20
_SUBSPACE, _KEPT, _INNER, _OUTER = 64, 16, 8, 300
_EXACT = 2.0**-46  # residuals, of the largest eigenvalue, that count as rounding error
_MOST = 1 << 62


def quantised(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(which rows, their vectors as whole numbers) of rows without null or non-finite entries, null or empty vectors left out."""
    sizes = np.array(column.value_lengths().fill_null(0))
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = np.flatnonzero((sizes > 0) & (bad[ends] == bad[ends - sizes]))
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.clip(np.floor(SCALE * flat), -_MOST, _MOST)
        whole = np.where(np.isfinite(whole), whole, 0).astype("i8")
    return good, [whole[ends[k] - sizes[k] : ends[k]] for k in good]


def packed(x: np.ndarray) -> bytes:
    """The vector in the narrowest of three whole-number types: equal vectors, equal bytes."""
    width = next(w for w in (2, 4, 8) if w == 8 or (-(1 << 8 * w - 1) <= x.min() and x.max() < 1 << 8 * w - 1))
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        _, found = quantised(b.column(0))
        seen = {packed(x): len(x) for x in found}
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int32())], names=["x", "size"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of equal size, stacked."""
    for b in batches:
        of: dict[int, list[np.ndarray]] = {}
        for size, x in zip(b.column("size").to_pylist(), b.column("x"), strict=True):
            of.setdefault(size, []).append(unpacked(x.as_py()))
        out = []
        for size, rows in of.items():
            step = max(1, min(_ROWS, _BLOCK // (8 * size)))
            out += [(size, len(rows[k : k + step]), packed(np.concatenate(rows[k : k + step]))) for k in range(0, len(rows), step)]
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["size", "rows", "block"])


def _summed(blocks: DataFrame, size: int, shape: int, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of f(rows) over all blocks, shape numbers. Each task adds its own; Spark adds those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for block in b.column("block"):
                total += f(unpacked(block.as_py()).reshape(-1, size).astype("f8")).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape)), pa.array(total)], names=["place", "part"])

    parts = blocks.select("block").mapInArrow(lean(run), "place long, part double").groupBy("place").agg(F.sum("part").alias("part"))
    out = np.zeros(shape)
    for r in parts.collect():
        out[r.place] = r.part
    return out


def _totals(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for b in batches:
            for block in b.column("block"):
                x = unpacked(block.as_py()).reshape(-1, size)
                total += (x.astype(object) if x.itemsize == 8 else x.astype("i8")).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], names=["place", "part"])

    return run


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns of t made orthonormal to each other and to those of against; what lies within them goes."""
    out = np.zeros((len(t), 0))
    for v in t.T:
        norm = np.linalg.norm(v)
        for _ in range(3):
            for q in (*against, out):
                v = v - q @ (q.T @ v)
        if norm > 0 and np.linalg.norm(v) > 1e-10 * norm:
            out = np.column_stack([out, v / np.linalg.norm(v)])
    return out


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one for each column of rhs; all columns share the products."""
    norm = np.linalg.norm(rhs, axis=0)
    safe = np.where(norm > 0, norm, 1)
    x, v0, v = np.zeros_like(rhs), np.zeros_like(rhs), rhs / safe
    w0, w1 = np.zeros_like(rhs), np.zeros_like(rhs)
    beta, left = np.zeros(rhs.shape[1]), norm.copy()
    c0, c1, s0, s1 = (np.full(rhs.shape[1], k) for k in (1.0, 1.0, 0.0, 0.0))
    alive = norm > 0
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v0
        after = np.linalg.norm(p, axis=0)
        # Two rotations from before and one new make the tridiagonal matrix triangular.
        far = s0 * beta
        near = c1 * c0 * beta + s1 * alpha
        bar = c1 * alpha - s1 * c0 * beta
        size = np.hypot(bar, after)
        ok = alive & (size > 0)
        size = np.where(ok, size, 1)
        c, s = bar / size, after / size
        w = (v - far * w0 - near * w1) / size
        x = x + np.where(ok, c * left, 0) * w
        left = np.where(ok, -s * left, left)
        v0, v = v, p / np.where(after > 0, after, 1)
        w0, w1, beta, c0, c1, s0, s1 = w1, w, after, c1, c, s1, s
        alive = ok & (after > 1e-14 * safe) & (np.abs(left) > goal * norm)
        if not alive.any():
            break
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of the largest ones of a symmetric matrix without negative ones.

    product gives the matrix times some columns. A pair is locked when its residual is below 2^-46 of the largest eigenvalue, or
    when the subspace is the whole space, or when three steps no longer halve one below 1e-11: then products round no better.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, size)
    locked, values, top = np.zeros((size, 0)), [], 0.0
    q = _orthonormal(rng.standard_normal((size, min(size, wanted + 2))))
    aq = product(q)
    last, still = np.inf, 0
    for _ in range(_OUTER):
        e, s = np.linalg.eigh((q.T @ aq + aq.T @ q) / 2)
        q, aq, e = q @ s[:, ::-1], aq @ s[:, ::-1], e[::-1]
        top = max([top, *values, *e[:1]])
        whole = q.shape[1] + locked.shape[1] >= size
        residual = aq - q * e
        size_of = np.linalg.norm(residual, axis=0)
        done = 0
        still = still + 1 if len(e) and last / 2 < size_of[0] <= 1e-11 * top else 0
        while done < min(wanted - len(values), len(e)) and (whole or size_of[done] <= _EXACT * top or (not done and still > 2)):
            done += 1
        last = size_of[done] if done < len(e) else np.inf
        if done:
            locked, values = np.column_stack([locked, q[:, :done]]), [*values, *e[:done]]
            q, aq, e, residual = q[:, done:], aq[:, done:], e[done:], residual[:, done:]
        if len(values) >= wanted or (whole and not len(e)):
            break
        n = min(wanted - len(values) + 1, q.shape[1])
        if not n or not top:
            t = rng.standard_normal((size, wanted))
        else:
            known = np.column_stack([locked, q[:, :n]])
            away = lambda m: m - known @ (known.T @ m)  # noqa: E731, B023
            shift = e[:n]
            t = minres(lambda m: away(product(away(m)) - shift * away(m)), -away(residual[:, :n]), _INNER, 0.05)  # noqa: B023
        if q.shape[1] + n > max(_SUBSPACE, 4 * wanted):
            q, aq = q[:, :_KEPT], aq[:, :_KEPT]
        new = _orthonormal(t, locked, q)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((size, wanted)), locked, q)
        if not new.shape[1]:
            break
        q, aq = np.column_stack([q, new]), np.column_stack([aq, product(new)])
    else:
        raise ArithmeticError(f"{wanted - len(values)} eigenpairs didn't converge in {_OUTER} steps")
    # Products made anew: rounding that gathered in the subspace's own ones goes.
    locked = np.linalg.qr(locked)[0]
    a = product(locked)
    e, s = np.linalg.eigh((locked.T @ a + a.T @ locked) / 2)
    return e[::-1], locked @ s[:, ::-1]


@dataclass
class Whitening:
    """n vectors of the fit list, their sums by dimension, the leading eigenvalues and eigenvectors, trace, identity error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def fit(embeddings: DataFrame, column: str = "embedding", components: int = 4) -> Whitening:
    """The whitening of each distinct vector of whole numbers floor(256 * entry), once.

    Vectors that are null or empty or have null or non-finite entries are left out, and those whose length isn't the most
    common one among distinct vectors (of equally common ones the largest). Components without variance, beyond the rank of
    the vectors, are left out; so a table of one distinct vector has none. Entries beyond 2^62 / 256 count as that.
    """
    spark = embeddings.sparkSession
    small_batches(spark)
    tables = Tables()
    distinct = embeddings.select(column).mapInArrow(lean(_vectors), "x binary, size int").distinct()
    stored = tables.written(distinct.mapInArrow(lean(_blocks), "size int, rows int, block binary"))
    sizes = stored.groupBy("size").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None:
        tables.drop()
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    size, n = sizes["size"], sizes["n"]
    blocks = stored.filter(F.col("size") == size).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = [0] * size
        for r in blocks.select("block").mapInArrow(lean(_totals(size)), "place long, part decimal(38,0)").groupBy("place").agg(F.sum("part").alias("part")).collect():
            sums[r.place] = int(r.part)
        mean = np.array([s / n for s in sums])
        trace = float(_summed(blocks, size, 1, lambda x: np.array([((x - mean) ** 2).sum()]))[0]) / n

        def product(m: np.ndarray) -> np.ndarray:
            def part(x):
                x -= mean
                return x.T @ (x @ m)

            return _summed(blocks, size, m.size, part).reshape(m.shape) / n

        if trace:
            values, vectors = jacobi_davidson(product, size, components)
            real = values > 1e-12 * max(values[0], 0)
            values, vectors = values[real], vectors[:, real]
        else:
            values, vectors = np.zeros(0), np.zeros((size, 0))
        k, error = len(values), 0.0
        if k:
            scaled = vectors / np.sqrt(values)
            middle = _summed(blocks, size, k, lambda x: ((x - mean) @ scaled).sum(0)) / n

            def spread(x):
                w = (x - mean) @ scaled - middle
                return w.T @ w

            error = float(np.abs(_summed(blocks, size, k * k, spread).reshape(k, k) / n - np.eye(k)).max())
    finally:
        blocks.unpersist()
        tables.drop()
    return Whitening(n, sums, values, vectors, trace, error)


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, model: Whitening, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of each row that ``fit`` takes, by component.

    deviation is the exact sum of (n * x - S)^2; null where that is beyond a long. Rows that repeat come out each, null ids
    too. Rows that ``fit`` leaves out, and empty tables, give none. Other columns are not read.
    """
    small_batches(embeddings.sparkSession)
    n, size, k = model.n, len(model.sums), len(model.values)
    largest = max(map(abs, model.sums), default=0)
    scaled = model.vectors / np.sqrt(model.values) if k else model.vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good, found = quantised(b.column(1))
            keep = [(i, x) for i, x in zip(good, found, strict=True) if len(x) == size]
            if not keep or not k:
                continue
            ids = b.column(0).take(pa.array([i for i, _ in keep]))
            x = np.stack([x for _, x in keep])
            bound = int(np.abs(x).max()) * n + largest
            moved = x * n - np.array(model.sums) if bound < _MOST else x.astype(object) * n - np.array(model.sums, object)
            if bound * bound * size < 1 << 63:
                deviation = (moved * moved).sum(1).tolist()
            else:
                wide = moved.astype(object)
                deviation = [d if d < 1 << 63 else None for d in (wide * wide).sum(1)]
            white = (moved / n).astype("f8") @ scaled
            rows = np.repeat(np.arange(len(keep)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(keep)), pa.int32()), pa.array(np.full(len(rows), n), pa.int64()),
                    pa.array(deviation, pa.int64()).take(pa.array(rows)), pa.array(white.ravel()), pa.array(np.tile(model.values / model.trace, len(keep))), pa.array(np.full(len(rows), model.identity_error)),
                ],
                names=[c.split()[0] for c in _OUT.split(", ")],
            )

    return embeddings.select(F.col(vec_id).cast("long"), column).mapInArrow(lean(run), _OUT)
