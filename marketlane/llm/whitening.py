"""Embedding whitening: principal components of a distributed covariance, found by classical dense methods.

Vectors become whole numbers ``floor(64 c) + 1,000,000``.  Everything is fitted on the
distinct ones, so copies carry no weight.  The fit list is written once in a compact
form (one byte a component where the values allow it); sums, covariance and the control
of the result are one pass over it each, with per-task sums that Spark adds up.  Values
are centred with the exact mean before they are multiplied.

The driver sees one matrix of ``width`` by ``width`` whatever the number of rows:
Householder reflections make it tridiagonal, Sturm counts bisect the leading
eigenvalues, inverse iteration gives their vectors, and vectors of close eigenvalues
are made orthogonal to each other.  ``width`` x 16 numbers go back to the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlane.llm.common import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: An eigenvalue at most this share of the trace, times the width, is noise of the arithmetic and no component.
NOISE = 1e-13
#: Whole components beyond this (an entry of 2^44) leave the exact range of the arithmetic.
LIMIT = 1 << 50
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# --- eigenvectors of one symmetric matrix ---------------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, neighbours and orthogonal ``Q`` with ``Q' matrix Q`` tridiagonal, by Householder reflections."""
    a = np.array(matrix, dtype=np.float64)
    size = len(a)
    q = np.eye(size)
    for k in range(size - 2):
        x = a[k + 1 :, k]
        scale = np.abs(x).max()
        if scale == 0.0 or not np.any(x[1:]):
            continue
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        # a <- H a H on the trailing block with H = 1 - 2 v v'
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = p - v * (v @ p)
        block -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        reflected = a[k + 1 :, k] - 2.0 * v * (v @ a[k + 1 :, k])
        a[k + 1 :, k] = a[k, k + 1 :] = 0.0
        a[k + 1, k] = a[k, k + 1] = reflected[0]
        q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: np.ndarray, beside: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Eigenvalues smaller than each point: negative pivots of the Sturm sequence."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count = np.zeros(len(points), dtype=np.int64)
    pivot = np.ones(len(points))
    square = np.concatenate([[0.0], beside**2])
    for k in range(len(diagonal)):
        pivot = diagonal[k] - points - square[k] / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues, falling, each bisected until its interval can't be halved."""
    size = len(diagonal)
    radius = np.concatenate([[0.0], np.abs(beside)]) + np.concatenate([np.abs(beside), [0.0]])
    slack = np.finfo(float).eps * (np.abs(diagonal) + radius).max() * 4 + np.finfo(float).tiny
    low = np.full(wanted, (diagonal - radius).min() - slack)
    high = np.full(wanted, (diagonal + radius).max() + slack)
    rank = size - 1 - np.arange(wanted)  # so many eigenvalues are smaller
    while True:
        middle = low + (high - low) / 2
        moving = (middle > low) & (middle < high)
        if not moving.any():
            return middle
        over = below(diagonal, beside, middle) > rank
        high = np.where(moving & over, middle, high)
        low = np.where(moving & ~over, middle, low)


def _solve(diagonal: np.ndarray, beside: np.ndarray, value: float, right: np.ndarray, floor: float) -> np.ndarray:
    """Solve ``(T - value) x = right`` by elimination with row exchanges; pivots are kept off zero."""
    size = len(diagonal)
    main, up, up2 = diagonal - value, np.append(beside, 0.0), np.zeros(size)
    x = right.copy()
    main, lower = main.copy(), beside.copy()
    for k in range(size - 1):
        if abs(lower[k]) > abs(main[k]):
            factor = main[k] / lower[k]
            main[k], old = lower[k], up[k]
            up[k] = main[k + 1]
            up2[k] = up[k + 1] if k + 1 < size - 1 else 0.0
            main[k + 1] = old - factor * up[k]
            if k + 1 < size - 1:
                up[k + 1] = -factor * up2[k]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            if abs(main[k]) < floor:
                main[k] = np.copysign(floor, main[k])
            factor = lower[k] / main[k]
            main[k + 1] -= factor * up[k]
            x[k + 1] -= factor * x[k]
    for k in range(size - 1, -1, -1):
        if abs(main[k]) < floor:
            main[k] = np.copysign(floor, main[k])
        tail = x[k]
        if k + 1 < size:
            tail -= up[k] * x[k + 1]
        if k + 2 < size:
            tail -= up2[k] * x[k + 2]
        x[k] = tail / main[k]
    return x


def leading_vectors(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    Values closer than a thousandth of the norm form a cluster; each iterate is made
    orthogonal to the vectors of its cluster found before.
    """
    size = len(matrix)
    wanted = min(wanted, size)
    diagonal, beside, q = tridiagonal(matrix)
    values = leading_values(diagonal, beside, wanted)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0), np.finfo(float).tiny)
    floor, vectors = np.finfo(float).eps * norm, np.zeros((size, wanted))
    start, shifted = 0, np.inf
    rng = np.random.default_rng(12)
    for k in range(wanted):
        if k and values[k - 1] - values[k] > 1e-3 * norm:
            start = k
        # equal shifts would give the same vector again
        shifted = min(values[k], shifted - 4 * floor) if k > start else values[k]
        x = rng.standard_normal(size)
        for _ in range(6):
            x /= np.abs(x).max()
            x = _solve(diagonal, beside, shifted, x, floor)
            for _ in range(2):
                x -= vectors[:, start:k] @ (vectors[:, start:k].T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    vectors = q @ vectors
    for k in range(wanted):  # the reflections leave a few rounding errors
        vectors[:, k] /= np.linalg.norm(vectors[:, k])
    return np.einsum("dk,de,ek->k", vectors, matrix, vectors), vectors


# --- packed rows ----------------------------------------------------------------------------------------------------


def _pack(rows: np.ndarray) -> list[bytes]:
    """Each row with its smallest item size in front: equal rows give equal bytes, whatever their neighbours."""
    peak = np.abs(rows).max(axis=1, initial=0)
    size = np.select([peak < 1 << 7, peak < 1 << 15, peak < 1 << 31], [1, 2, 4], 8)
    out: list[bytes] = [b""] * len(rows)
    for n in (1, 2, 4, 8):
        own = np.flatnonzero(size == n)
        narrow = np.ascontiguousarray(rows[own].astype(f"<i{n}"))
        for k, row in zip(own.tolist(), narrow):
            out[k] = bytes([n]) + row.tobytes()
    return out


def _unpack(packed: list[bytes], width: int) -> np.ndarray:
    out = np.empty((len(packed), width), dtype=np.int64)
    sizes = np.array([p[0] for p in packed], dtype=np.int64)
    for n in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == n)
        flat = b"".join(packed[k][1:] for k in own.tolist())
        out[own] = np.frombuffer(flat, dtype=f"<i{n}").reshape(-1, width)
    return out


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, width, x``: rows that take part; ``x`` packs ``floor(64 c)`` of each component."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c * SCALE) >= LIMIT))
    rows = rows.where(F.col("v").isNotNull() & ~bad).withColumn("width", F.size("v")).where(F.col("width") > 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy(zero_copy_only=False)
            flat = np.floor(batch.column("v").flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64)
            ends = np.cumsum(widths)
            out: list[bytes] = [b""] * len(widths)
            for width in np.unique(widths).tolist():
                own = np.flatnonzero(widths == width)
                places = (ends[own] - width)[:, None] + np.arange(width)[None, :]
                for k, p in zip(own.tolist(), _pack(flat[places])):
                    out[k] = p
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("width"), pa.array(out, pa.binary())], names=["vec_id", "width", "x"])

    return rows.mapInArrow(pack, "vec_id long, width int, x binary")


# --- distributed sums -----------------------------------------------------------------------------------------------


def _per_task(fit: DataFrame, width: int, start: Callable, add: Callable, finish: Callable, schema: str) -> DataFrame:
    """One small result per task over the packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, some = start(), False
        for batch in batches:
            packed = batch.column("x").to_pylist()
            for k in range(0, len(packed), 4096):
                state, some = add(state, _unpack(packed[k : k + 4096], width)), True
        if some:
            yield from finish(state)

    return fit.select("x").mapInArrow(run, schema)


def sums(fit: DataFrame, width: int) -> tuple[int, list[int], int]:
    """Rows, exact sums per dimension (in two halves, so that no long overflows) and the largest component."""

    def finish(state):
        n, low, high, peak = state
        columns = [np.arange(width, dtype=np.int32), np.full(width, n), low, high, np.full(width, peak)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "n", "low", "high", "peak"])

    def add(state, x):
        n, low, high, peak = state
        return n + len(x), low + (x & 0xFFFFFFFF).sum(axis=0), high + (x >> 32).sum(axis=0), max(peak, int(np.abs(x).max()))

    zero = lambda: (0, np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64), 0)
    parts = _per_task(fit, width, zero, add, finish, "d int, n long, low long, high long, peak long")
    total = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "low", "high")]
    rows = parts.groupBy("d").agg(*total, F.max("peak").alias("peak")).orderBy("d").collect()
    if not rows:
        return 0, [], 0
    return int(rows[0]["n"]), [int(r["low"]) + (int(r["high"]) << 32) for r in rows], max(r["peak"] for r in rows)


def centred(x: np.ndarray, n: int, total: np.ndarray, whole: bool) -> np.ndarray:
    """``x - S/n``: exact in whole numbers before the one division, where ``n x - S`` fits a long."""
    if whole:
        return (n * x - total[None, :]) / float(n)
    return x - np.array([int(s) / n for s in total.tolist()])[None, :]


def products(fit: DataFrame, width: int, size: int, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the fit list of the outer product of ``values(x)``, ``size`` by ``size``."""
    i, j = np.triu_indices(size)

    def finish(state):
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(state[i, j])], names=["i", "j", "v"])

    def add(state, x):
        y = values(x)
        return state + y.T @ y

    parts = _per_task(fit, width, lambda: np.zeros((size, size)), add, finish, "i int, j int, v double")
    out = np.zeros((size, size))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["v"]
    return out


def means(fit: DataFrame, width: int, size: int, n: int, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    def finish(state):
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(state)], names=["i", "v"])

    parts = _per_task(fit, width, lambda: np.zeros(size), lambda s, x: s + values(x).sum(axis=0), finish, "i int, v double")
    out = np.zeros(size)
    for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[row["i"]] = row["v"] / n
    return out


# --- the operator ---------------------------------------------------------------------------------------------------


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    ``vectors`` has ``vec_id, embedding``; other columns are ignored.  Missing vectors and
    those with missing or non-finite entries take no part, nor do empty ones.  Every other
    row gives its rows, repeated rows and rows without an id too; the fit counts each
    distinct vector once.  Components are numbered by falling eigenvalue; equal eigenvalues
    have no order of their own and get orthogonal vectors.  Directions without variance
    (all rows equal, fewer distinct rows than components) can't be scaled to one and are
    left out, so there may be fewer than ``components``, or none.  Only vectors of the
    commonest width are used (ties: the wider).  ``deviation`` is missing where the exact
    sum exceeds a long, and entries of 2^44 and more count as non-finite.  An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = written(whole_vectors(vectors), "whitening-rows")
    widths = sorted(((r["n"], r["width"]) for r in rows.groupBy("width").agg(F.count("*").alias("n")).collect()), reverse=True)
    if not widths:
        return _empty(spark)
    width = widths[0][1]
    rows = rows.where(F.col("width") == width)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    n, total, peak = sums(fit, width)
    whole = 2 * n * peak < 1 << 62  # n x - S then fits a long
    total = np.array(total, dtype=np.int64 if whole else object)
    values = lambda x: centred(x, n, total, whole)
    covariance = products(fit, width, width, values) / n
    trace = float(np.trace(covariance))
    if not trace > 0.0:
        return _empty(spark)
    eigen, vectors_ = leading_vectors(covariance, components)
    kept = eigen > NOISE * width * trace
    eigen, vectors_ = eigen[kept], vectors_[:, kept]
    scaled = vectors_ / np.sqrt(eigen)[None, :]
    project = lambda x: centred(x, n, total, whole) @ scaled
    size = len(eigen)
    middle = means(fit, width, size, n, project)
    spread = products(fit, width, size, lambda x: project(x) - middle[None, :]) / n
    error = float(np.abs(spread - np.eye(size)).max())
    share = eigen / trace

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(1, size + 1, dtype=np.int32)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x = _unpack(part.column("x").to_pylist(), width)
                count = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(np.repeat(np.arange(count), size))),
                        pa.array(np.tile(number, count)),
                        pa.array(np.full(count * size, n)),
                        pa.array([d for d in deviations(x, n, total) for _ in range(size)], pa.int64()),
                        pa.array(project(x).ravel()),
                        pa.array(np.tile(share, count)),
                        pa.array(np.full(count * size, error)),
                    ],
                    names=[c.split()[0] for c in RESULT.split(", ")],
                )

    return rows.select("vec_id", "x").mapInArrow(emit, RESULT)


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Exact sum over dimensions of ``(n x - S)^2`` of each row; None where it exceeds a long."""
    rough = ((n * x.astype(np.float64) - total.astype(np.float64)[None, :]) ** 2).sum(axis=1)
    if rough.max(initial=0.0) < 4e18 and total.dtype != object:
        return ((n * x - total[None, :]) ** 2).sum(axis=1).tolist()
    whole = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row.tolist(), total.tolist())) for row in x]
    return [w if w < 1 << 63 else None for w in whole]
