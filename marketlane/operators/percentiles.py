"""Exact percentiles without sorting or gathering all values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

# Decimal digits settled per pass: a pass ranks at most 10^4 groups per wanted rank.
DIGITS = 4


def percentiles(
    rows: DataFrame, value: str, points: Mapping[str, float], scale: int = 0, digits: int = 12
) -> DataFrame:
    """One row of interpolated percentiles of non-negative numbers, and their maximum.

    ``scale`` is the number of decimal places and ``digits`` the total number of
    digits.  Values are counted per distinct value first.  The wanted ranks are
    then found digit group by digit group: each pass counts by the next four
    digits and keeps the one group that holds the rank, so no task ever sees
    more than 10^4 groups per rank, however many values there are.  A value that
    is negative, longer or finer than stated fails the job.
    """
    unit = F.lit(10**scale)
    scaled = F.col(value) * unit
    fits = (scaled >= 0) & (scaled < F.lit(10**digits)) & (scaled == scaled.cast("bigint"))
    stop = F.raise_error(F.concat(F.lit(f"{value} is not a number of {digits} digits, {scale} of them decimal: "), F.col(value).cast("string")))
    histogram = (
        rows.where(F.col(value).isNotNull())
        .groupBy(F.when(fits, scaled.cast("bigint")).otherwise(stop.cast("bigint")).alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    passes = -(-digits // DIGITS)
    width = 10 ** (DIGITS * (passes - 1))
    # First pass: all values by their leading digits, one small sorted group.
    ordered = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("_group").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    leading = (
        histogram.groupBy(F.expr(f"_v div {width}").alias("_group"))
        .agg(F.sum("_n").alias("_n"), F.max("_v").alias("_max"))
        .withColumns(
            {
                "_upto": F.sum("_n").over(ordered),
                "_total": F.sum("_n").over(everything),
                "_max": F.max("_max").over(everything),
            }
        )
    )
    position = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in points.items()}
    wanted = [
        F.struct(
            F.lit(name).alias("name"), F.lit(side).alias("side"),
            f(position[name]).cast("bigint").alias("rank"), position[name].alias("position"),
        )
        for name in points
        for side, f in (("low", F.floor), ("high", F.ceil))
    ]
    targets = _holding(leading.select("*", F.explode(F.array(*wanted)).alias("w")).select("*", "w.*"))
    for left in reversed(range(passes - 1)):
        width, outer = 10 ** (DIGITS * left), 10 ** (DIGITS * (left + 1))
        # Two target rows per point, each with the digits found so far.
        candidates = (
            histogram.withColumn("_prefix", F.expr(f"_v div {outer}"))
            .join(F.broadcast(targets), "_prefix")
            .groupBy("name", "side", "rank", "position", "_max", F.expr(f"_v div {width}").alias("_group"))
            .agg(F.sum("_n").alias("_n"))
        )
        running = Window.partitionBy("name", "side").orderBy("_group").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        targets = _holding(candidates.withColumn("_upto", F.sum("_n").over(running)))
    share = F.col("position") - F.floor("position")
    weight = F.when(F.col("side") == "low", 1 - share).otherwise(share)
    found = targets.withColumn("_part", F.col("_prefix") / unit * weight)
    return found.agg(
        *[F.sum(F.when(F.col("name") == name, F.col("_part"))).alias(name) for name in points],
        (F.max("_max") / unit).alias("max_value"),
    )


def _holding(groups: DataFrame) -> DataFrame:
    """Per target the group its rank falls into, and the rank inside that group."""
    before = F.col("_upto") - F.col("_n")
    return groups.where((F.col("_upto") > F.col("rank")) & (before <= F.col("rank"))).select(
        "name", "side", (F.col("rank") - before).alias("rank"), "position", "_max",
        F.col("_group").alias("_prefix"),
    )
