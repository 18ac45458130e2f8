"""Cohort retention: who of a monthly cohort is active how many months later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from marketlane.functions.dates import month_start, months_between_starts


def active_months(orders: DataFrame, user: str, ts: str) -> DataFrame:
    """Distinct user and month of activity."""
    return orders.select(user, month_start(ts).alias("active_month")).distinct()


def retention(cohorts: DataFrame, activity: DataFrame, user: str) -> DataFrame:
    """``cohort, month_offset, users``; activity before the cohort month is left out.

    ``cohorts`` has one row per user and ``activity`` one per user and month,
    so plain counting is already the exact distinct count.
    """
    return (
        cohorts.join(activity, user)
        .where(F.col("active_month") >= F.col("cohort"))
        .groupBy("cohort", months_between_starts("cohort", "active_month").alias("month_offset"))
        .agg(F.count("*").alias("users"))
    )


def retention_matrix(long: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """One row per cohort, one column ``m<offset>`` per listed month; an offset that is not listed fails the job."""
    known = F.col("month_offset").isin(list(offsets))
    stop = F.raise_error(F.concat(F.lit("month offset not listed: "), F.col("month_offset").cast("string"))).cast("boolean")
    complete = long.where(F.when(known, True).otherwise(stop))
    wide = complete.groupBy("cohort").pivot("month_offset", list(offsets)).agg(F.sum("users"))
    return wide.select(
        "cohort", *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(f"m{k}") for k in offsets]
    )


def offset_span(cohorts: DataFrame, activity: DataFrame) -> range:
    """Every month offset that can occur: from none to the first cohort's distance to the last active month."""
    first = cohorts.agg(F.min("cohort").alias("month")).first()["month"]
    last = activity.agg(F.max("active_month").alias("month")).first()["month"]
    if first is None or last is None:
        return range(1)
    return range(max(0, 12 * (last.year - first.year) + last.month - first.month) + 1)


def retention_share(long: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Percent of the cohort that is active in each later month."""
    sizes = cohorts.groupBy("cohort").agg(F.count("*").alias("cohort_users"))
    share = F.round(F.col("users") * 100.0 / F.col("cohort_users"), 2)
    return long.join(sizes, "cohort").select(
        "cohort", "month_offset", "users", "cohort_users", share.alias("pct")
    )
