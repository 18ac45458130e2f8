"""Exact nearest neighbours by blocked int8 products with error bounds.

Vectors are quantised to int8 with one scale each.  A product of two quantised
tiles differs from the products of the vectors by at most a bound made of the
lengths of the rounding residues, so a pair whose upper bound lies below what the
query already has can't enter its result.  Surviving pairs are computed anew in
double precision, and heaps of ``k`` per query merge tile by tile and then task
by task.

Query blocks and candidate blocks meet by a join on the query block's number:
each candidate block is sent to the tasks of every query block.  No tile, heap or
block grows with the data, only their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlane.llm.common import written

K = 20
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of vectors that are present, not zero, and finite in every component."""
    v = F.col("embedding").cast("array<float>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


def quantised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, length of each quantised row and of its residue."""
    peak = np.abs(matrix).max(axis=1)
    scale = np.where(peak > 0, peak / 127.0, 1.0)
    q = np.rint(matrix / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(matrix - back, axis=1)


def blocks(rows: DataFrame, number: Column, size: int) -> DataFrame:
    """Rows ``block, ids, vectors``: at most ``size`` vectors of one number and length as packed little-endian bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def emit(key):
            ids, vectors = zip(*held.pop(key))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]], pa.int64()),
                    pa.array([key[1]], pa.int32()),
                    pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()),
                    pa.array([np.array(vectors, dtype="<f4").tobytes()], pa.binary()),
                ],
                names=["block", "width", "ids", "vectors"],
            )

        for batch in batches:
            for number, vec_id, v in zip(*(batch.column(n).to_pylist() for n in ("block", "vec_id", "v"))):
                own = held.setdefault((number, len(v)), [])
                own.append((vec_id, v))
                if len(own) == size:
                    yield emit((number, len(v)))
        for key in list(held):
            yield emit(key)

    return rows.select(number.alias("block"), "vec_id", "v").mapInArrow(pack, "block long, width int, ids binary, vectors binary")


class Heaps:
    """The ``k`` best candidates so far of each query of one block."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix.astype(np.float64), k
        self.q, self.scale, self.length, self.residue = quantised(self.matrix)
        self.norm = np.linalg.norm(self.matrix, axis=1)
        self.best = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def offer(self, ids: np.ndarray, matrix: np.ndarray):
        matrix = matrix.astype(np.float64)
        q, scale, length, residue = quantised(matrix)
        # int8 products are exact in float32 up to 1,000 components, in float64 beyond any width in use
        exact = np.float32 if self.q.shape[1] <= 1000 else np.float64
        tile = (self.q.astype(exact) @ q.T.astype(exact)).astype(np.float64) * self.scale[:, None] * scale[None, :]
        slack = self.length[:, None] * residue[None, :] + self.residue[:, None] * np.linalg.norm(matrix, axis=1)[None, :]
        slack += 1e-9 * (np.abs(tile) + slack) + 1e-300
        tile[self.ids[:, None] == ids[None, :]] = -np.inf  # a query is no candidate of its own
        k = self.k
        if len(ids) > k:
            sure = -np.partition(-(tile - slack), k - 1, axis=1)[:, k - 1]
            floor = np.maximum(self.floor, sure)
        else:
            floor = self.floor
        for row, columns in _hits(tile + slack >= floor[:, None]):
            columns = columns[tile[row, columns] > -np.inf]
            scores = np.cumsum(self.matrix[row] * matrix[columns], axis=1)[:, -1]  # one after the other, as SQL adds
            held, names = self.best[row]
            held, names = np.concatenate([held, scores]), np.concatenate([names, ids[columns]])
            order = np.lexsort((names, -held))[:k]
            self.best[row] = held[order], names[order]
            if len(order) == k:
                self.floor[row] = held[order[-1]]

    def rows(self) -> pa.RecordBatch:
        counts = [len(h) for h, _ in self.best]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.ids, counts)),
                pa.array(np.concatenate([n for _, n in self.best])),
                pa.array(np.concatenate([h for h, _ in self.best])),
            ],
            names=["query_id", "vec_id", "score"],
        )


def _hits(mask: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for row in np.flatnonzero(mask.any(axis=1)):
        yield row, np.flatnonzero(mask[row])


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = K,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query, nearest first.

    Both frames have ``vec_id, embedding``; a query is no candidate of its own id.
    Ties go to the smaller id.  Missing and zero vectors, vectors with missing or
    non-finite components and rows without an id take no part; vectors of another
    width than the query's are no candidates.  Repeated rows count once if they
    are equal; an id with two vectors is two candidates.  No rows on either side
    give no rows.
    """
    asked = written(usable(queries).distinct(), "ann-queries")
    offered = written(usable(candidates).distinct(), "ann-candidates")
    count = asked.count()
    parts = max(1, -(-count // query_block))
    number = F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_number = asked.select("vec_id", "v", number.alias("n")).repartition(min(parts, tasks), "n")
    query_blocks = blocks(by_number, F.col("n"), query_block)
    packed = blocks(offered, F.lit(0).cast("long"), candidate_block).drop("block")
    sent = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("block", F.col("block").cast("long"))
    tiles = sent.withColumnsRenamed({"ids": "c_ids", "vectors": "c_vectors"}).join(
        query_blocks.withColumnsRenamed({"ids": "q_ids", "vectors": "q_vectors"}), ["block", "width"]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[bytes, Heaps] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                width, c_ids, c_vectors, q_ids, q_vectors = (
                    batch.column(n)[row].as_py() for n in ("width", "c_ids", "c_vectors", "q_ids", "q_vectors")
                )
                if q_ids not in open_blocks:
                    if len(open_blocks) == 8:
                        yield open_blocks.pop(next(iter(open_blocks))).rows()
                    matrix = np.frombuffer(q_vectors, dtype="<f4").reshape(-1, width)
                    open_blocks[q_ids] = Heaps(np.frombuffer(q_ids, dtype="<i8"), matrix, k)
                open_blocks[q_ids].offer(np.frombuffer(c_ids, dtype="<i8"), np.frombuffer(c_vectors, dtype="<f4").reshape(-1, width))
        for heaps in open_blocks.values():
            yield heaps.rows()

    found = tiles.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_every(vectors: DataFrame, step: int, k: int = K) -> DataFrame:
    """The stated query set, rows whose id is divisible by ``step``, against all rows."""
    return nearest(vectors.where(F.col("vec_id") % step == 0), vectors, k)
