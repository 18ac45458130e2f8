"""Longest ordered chain of steps within a time window, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlane.functions.dates import epoch_seconds


def window_funnel(
    events: DataFrame,
    key: Sequence[str],
    ts: str,
    steps: Sequence[Column],
    window_seconds: int,
    out: str = "level",
) -> DataFrame:
    """Per key: how many of ``steps`` were reached in order within the window.

    The window runs from the first step of a chain, its bound is inclusive and
    equal seconds count as ordered.  Level 0 means the first step never occurs.

    A key of any size is cut into time buckets as long as the window.  A chain
    that starts in bucket ``b`` ends in ``b`` or ``b + 1``, so group ``b`` gets
    the rows of ``b`` and, of the next bucket, those that can continue a chain.
    Rows are merged per second, which bounds a group by twice the window length
    in seconds however many events one key has.  Buckets are given out first, so
    the merge and the windows share one exchange by key and bucket; what is
    combined before it leaves at most one row per second and task.
    """
    n = len(steps)
    flags = [f"_f{i}" for i in range(n)]
    continues = F.lit(False)
    for f in flags[1:]:
        continues = continues | F.col(f)
    flagged = events.select(
        *key,
        epoch_seconds(ts).alias("_sec"),
        *[F.coalesce(s, F.lit(False)).alias(f) for s, f in zip(steps, flags)],
    ).withColumn("_own", F.floor(F.col("_sec") / window_seconds))
    placed = (
        flagged.withColumn(
            "_bucket",
            F.explode(
                F.when(continues, F.array(F.col("_own"), F.col("_own") - 1)).otherwise(
                    F.array(F.col("_own"))
                )
            ),
        )
        .repartition(*key, "_bucket")
        .groupBy(*key, "_bucket", "_own", "_sec")
        .agg(*[F.max(f).alias(f) for f in flags])
    )
    # Seconds are unique inside a group, so a row frame already covers all peers.
    running = (
        Window.partitionBy(*key, "_bucket")
        .orderBy("_sec")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    starts = F.col("_f0") & (F.col("_own") == F.col("_bucket"))
    chain = placed.withColumn("_c0", F.when(starts, F.col("_sec")))
    level = F.when(F.col("_c0").isNotNull(), 1).otherwise(0)
    for i in range(1, n):
        # Latest possible chain start among chains that reached step i.
        chain = chain.withColumn(f"_s{i - 1}", F.max(f"_c{i - 1}").over(running))
        reached = F.col(flags[i]) & (F.col("_sec") <= F.col(f"_s{i - 1}") + window_seconds)
        chain = chain.withColumn(f"_c{i}", F.when(reached, F.col(f"_s{i - 1}")))
        level = F.when(F.col(f"_c{i}").isNotNull(), i + 1).otherwise(level)
    return chain.groupBy(*key).agg(F.max(level).alias(out))


def level_histogram(levels: DataFrame, level: str = "level", out: str = "sessions") -> DataFrame:
    return levels.groupBy(level).agg(F.count("*").alias(out))
