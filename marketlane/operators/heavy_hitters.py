"""The greatest sums per key, exact, without shuffling every key.

Summaries in the manner of Misra and Gries, for weights: at most ``counters`` keys with
a lower bound of their sum, and one offset by which any sum, also that of a key that is
not listed, can be greater.  Where there are more keys, the next greatest bound is taken off all of
them.  Summaries add up: bounds are summed per key, offsets altogether.

Bounds decide which keys can be among the greatest at all; only those are then summed
exactly, in a second pass that needs no shuffle of the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

COUNTERS = 1000
#: Rows that a task collects before it sums and cuts them.
PENDING = 1 << 18
#: Most keys that the second pass looks up by broadcast; a bound of its size.
MOST_SURVIVORS = 100_000


def _begins(table: pa.Table, by: Sequence[str]) -> np.ndarray:
    """Rows at which a group begins, of a table sorted by its groups."""
    change = np.zeros(table.num_rows, dtype=bool)
    change[:1] = True
    for c in by:
        code = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode")
        code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy(zero_copy_only=False)
        change[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(change)


def _shrunk(sums: pa.Table, by: Sequence[str], counters: int) -> tuple[pa.Table, pa.Table]:
    """The greatest sums of each group, less the first that has no place, and how much that was (``by, offset``)."""
    ranked = sums.take(pc.sort_indices(sums, sort_keys=[(c, "ascending") for c in by] + [("weight", "descending")]))
    weight = ranked.column("weight").to_numpy()
    begins = _begins(ranked, by)
    sizes = np.diff(np.r_[begins, len(weight)])
    over = sizes > counters
    off = np.zeros(len(begins), dtype=np.int64)
    off[over] = weight[begins[over] + counters]
    taken = np.repeat(off, sizes)
    rank = np.arange(len(weight)) - np.repeat(begins, sizes)
    keep = (rank < counters) & ((weight > taken) | (taken == 0))
    lowered = ranked.set_column(ranked.schema.get_field_index("weight"), "weight", pa.array(weight - taken))
    lost = pa.table([*(ranked.column(c).take(begins[off > 0]) for c in by), pa.array(off[off > 0])], names=[*by, "offset"])
    return lowered.filter(pa.array(keep)), lost


def summaries(rows: DataFrame, key: str, weight: str, by: Sequence[str] = (), counters: int = COUNTERS) -> DataFrame:
    """``by, key, weight, offset``: one summary per task and group, its ``offset`` on rows without key.

    ``weight`` is a whole number, not negative.  Memory is one summary per group
    of ``by`` that a task meets (days, say) and ``PENDING`` rows; rows without a key or weight are left out.
    """
    fields = [rows.schema[c] for c in (*by, key)]
    schema = T.StructType([*fields, T.StructField("weight", T.LongType()), T.StructField("offset", T.LongType())])
    group = [*by, key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Table] = []

        def fold() -> Iterator[pa.RecordBatch]:
            sums = pa.concat_tables(pending).group_by(group).aggregate([("weight", "sum")]).rename_columns([*group, "weight"])
            kept, lost = _shrunk(sums, by, counters)
            pending[:] = [kept]
            if lost.num_rows:
                size = lost.num_rows
                nothing = [pa.nulls(size, kept.schema.field(key).type), pa.array(np.zeros(size, dtype=np.int64))]
                columns = [*(lost.column(c).combine_chunks() for c in by), *nothing, lost.column("offset").combine_chunks()]
                yield from pa.table(columns, names=[*group, "weight", "offset"]).to_batches()

        size = 0
        for batch in batches:
            pending.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= PENDING:
                yield from fold()
                size = 0
        if pending:
            yield from fold()
            kept = pending[0]
            yield from kept.append_column("offset", pa.array(np.zeros(kept.num_rows, dtype=np.int64))).to_batches()

    used = rows.select(*by, key, F.col(weight).cast("bigint").alias("weight")).where(F.col(key).isNotNull() & F.col("weight").isNotNull())
    negative = F.raise_error(F.lit("weights of heavy hitters must not be negative")).cast("bigint")
    used = used.withColumn("weight", F.when(F.col("weight") < 0, negative).otherwise(F.col("weight")))
    return used.mapInArrow(run, schema)


def merge(parts: DataFrame, key: str, by: Sequence[str] = (), counters: int = COUNTERS) -> DataFrame:
    """Partial summaries of each group to one, with at most ``counters`` keys again."""
    sums = parts.groupBy(*by, key).agg(F.sum("weight").alias("weight"), F.sum("offset").alias("offset"))
    # The keys of a merge: at most ``counters`` for each of its parts.
    rank = Window.partitionBy(*by).orderBy(F.col(key).isNull(), F.col("weight").desc())
    ranked = sums.withColumn("_rank", F.row_number().over(rank))
    cut = Window.partitionBy(*by)
    off = F.coalesce(F.max(F.when((F.col("_rank") == counters + 1) & F.col(key).isNotNull(), F.col("weight"))).over(cut), F.lit(0))
    lowered = ranked.withColumn("_off", off)
    kept = lowered.where(F.col(key).isNull() | (F.col("_rank") <= counters))
    counted = kept.where(F.col(key).isNotNull() & (F.col("weight") > F.col("_off")))
    lines = counted.select(*by, key, (F.col("weight") - F.col("_off")).alias("weight"), F.lit(0).cast("bigint").alias("offset"))
    offsets = lowered.groupBy(*by).agg(F.sum("offset").alias("_before"), F.max("_off").alias("_off"))
    no_key = F.lit(None).cast(parts.schema[key].dataType).alias(key)
    extra = offsets.select(*by, no_key, F.lit(0).cast("bigint").alias("weight"), (F.col("_before") + F.col("_off")).alias("offset"))
    return lines.unionByName(extra.where("offset > 0"))


def survivors(parts: DataFrame, key: str, n: int) -> tuple[DataFrame, bool]:
    """Keys that can be among the ``n`` greatest, and whether all others are ruled out."""
    bounds = parts.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("weight").alias("low"))
    off = parts.agg(F.coalesce(F.sum("offset"), F.lit(0))).first()[0]
    top = [r["low"] for r in bounds.select("low").orderBy(F.desc("low")).limit(n).collect()]
    least = top[-1] if len(top) == n else 0
    # a key without a counter has at most ``off``; equal sums stay, as ties are ordered by key
    sure = off == 0 or (len(top) == n and off < least)
    return bounds.where(F.col("low") + off >= least).select(key), sure


def top_sums(rows: DataFrame, key: str, weight: str, n: int, parts: DataFrame | None = None, counters: int = COUNTERS) -> DataFrame:
    """``key, weight``: the ``n`` greatest sums, exact; equal sums by key.

    ``parts`` are stored summaries of the same rows; without them they are made
    first.  Where bounds rule out too little (flat sums, too few counters), all
    keys are summed instead.
    """
    parts = summaries(rows, key, weight, counters=counters) if parts is None else parts
    wanted, sure = survivors(parts, key, n)
    used = rows.select(key, F.col(weight).cast("bigint").alias("weight")).where(F.col(key).isNotNull())
    if sure and wanted.limit(MOST_SURVIVORS + 1).count() <= MOST_SURVIVORS:
        used = used.join(F.broadcast(wanted), key, "left_semi")
    return used.groupBy(key).agg(F.sum("weight").alias("weight")).where(F.col("weight").isNotNull()).orderBy(F.desc("weight"), key).limit(n)
