"""Aggregate states that merge: exact sets as bitmaps, sets as theta sketches, distributions as KLL sketches.

Each kind has a state (built from rows), a merge (of states, still a state)
and readers.  Merging takes any number of partial states in any order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from marketlane.functions.columns import as_column

# ---- exact sets of numbered keys: 32,768 numbers a bucket, one bitmap of 4 KB ----


def _apart(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of one bitmap together, in as many partitions as the session shuffles into.

    A sparse bitmap is sent at a fraction of its 4 KB, so partitions merged by the bytes sent, and bitmaps
    summed before they are sent, would fill a task's memory.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, "bucket")


def bitmap_states(rows: DataFrame, number: str, *by: str) -> DataFrame:
    """``by, bucket, members``: the numbers of each group as bitmaps."""
    placed = rows.select(*by, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("_bit"))
    return _apart(placed, *by).groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("members"))


def bitmap_merge(states: DataFrame, *by: str) -> DataFrame:
    return _apart(states, *by).groupBy(*by, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def bitmap_distinct(states: DataFrame, *by: str, out: str = "n") -> DataFrame:
    """Distinct numbers of each group, exact, over any partial states."""
    return bitmap_merge(states, *by).groupBy(*by).agg(F.sum(F.bitmap_count("members")).alias(out))


# ---- theta sketches: unions and intersections of sets ----

THETA_LOG_ENTRIES = 14


def theta_state(c: str | Column, log_entries: int = THETA_LOG_ENTRIES) -> Column:
    return F.theta_sketch_agg(as_column(c), log_entries)


def theta_merge(c: str | Column, log_entries: int = THETA_LOG_ENTRIES) -> Column:
    return F.theta_union_agg(as_column(c), log_entries)


def theta_overlap(a: str | Column, b: str | Column) -> Column:
    """Estimated size of the intersection."""
    return F.theta_sketch_estimate(F.theta_intersection(as_column(a), as_column(b)))


def theta_bound(overlap: Column, larger: Column, log_entries: int = THETA_LOG_ENTRIES, deviations: float = 4.0) -> Column:
    """Largest difference to expect of an overlap: so many standard deviations.

    A sketch of a set larger than ``2^log_entries`` keeps a share ``2^log_entries / larger``
    of it at random, so the overlap is a binomial count divided by that share.
    Smaller sets are kept whole and their overlaps are exact.
    """
    entries = float(2**log_entries)
    return F.when(larger <= entries, 0.0).otherwise(deviations * F.sqrt(overlap * larger / entries) + 1.0)


# ---- KLL sketches: quantiles ----

KLL_K = 400


def kll_state(c: str | Column, k: int = KLL_K) -> Column:
    return F.kll_sketch_agg_double(as_column(c).cast("double"), k)


def kll_merge(c: str | Column, k: int = KLL_K) -> Column:
    return F.kll_merge_agg_double(as_column(c), k)


def kll_quantile(c: str | Column, point: float) -> Column:
    """Value whose rank is near ``point``."""
    return F.kll_sketch_get_quantile_double(as_column(c), F.lit(point))


def kll_rank_error(k: int = KLL_K) -> float:
    """Normalised rank error at 99 % confidence for one quantile; the published fit for this sketch."""
    return 2.296 / math.pow(k, 0.9021)
