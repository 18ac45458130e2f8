"""Whole numbers for keys, given once and kept, so that sets of keys fit into bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def numbered(keys: DataFrame, key: str, known: DataFrame | None = None, groups: int | None = None) -> DataFrame:
    """``key, number`` of the keys that ``known`` does not hold, counted on from its highest number.

    Numbers have no gaps and depend on the keys alone: keys are dealt into
    ``groups`` by hash, numbered by key inside each, and groups follow one
    another.  No task sees more than its group.  Missing keys get no number.
    """
    groups = groups or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
        first = F.lit(known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]).cast("bigint")
    dealt = fresh.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))
    inside = F.row_number().over(Window.partitionBy("_group").orderBy(key)).cast("bigint")
    ranked = dealt.withColumn("_inside", inside)
    # One row per group, so one task is enough.
    upto = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = dealt.groupBy("_group").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_group", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    return ranked.join(offsets, "_group").select(key, (first + F.col("_before") + F.col("_inside") - 1).alias("number"))
