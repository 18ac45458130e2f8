"""Versions of a key over time, and the one that was valid when a row happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlane.functions.dates import epoch_seconds
from marketlane.operators.copies import first_per_key

DAY_SECONDS = 86400


def change_points(deliveries: DataFrame, key: str, valid_from: str, columns: Sequence[str]) -> DataFrame:
    """``key, valid_from, valid_to, columns``: deliveries that changed anything, each until the next one.

    Several deliveries of one time count as one, the greatest by ``columns``;
    rows without a key or time are no versions.  The last version has no end.
    """
    known = deliveries.select(key, valid_from, *columns).where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    one = first_per_key(known, [key, valid_from], [F.col(c).desc() for c in columns])
    order = Window.partitionBy(key).orderBy(valid_from)
    values = F.struct(*columns)
    changed = one.withColumns({"_before": F.lag(values).over(order), "_first": F.row_number().over(order) == 1}).where(
        F.col("_first") | ~F.col("_before").eqNullSafe(values)
    )
    until = F.lead(valid_from).over(order).alias("valid_to")
    return changed.select(key, valid_from, until, *columns)


def _bucket(ts: str | Column, seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / seconds)


def valid_at(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str,
    columns: Sequence[str],
    prefix: str = "",
    bucket_seconds: int = 30 * DAY_SECONDS,
) -> DataFrame:
    """Add to every row the ``columns`` of the version of its ``key`` that was valid ``at`` its time.

    A version holds from ``valid_from`` on, its own second included, until the
    next one; of versions with equal times the greatest by ``columns`` holds.  Rows
    before the first version, without a key or without a time get NULL.  All rows
    stay, repeated ones too.

    Both sides are laid in one order and the last version is carried forward, so
    the work is the sum of both sides, never the product of a key's rows and
    versions.  A key of any size is cut into time buckets.  What is valid when a
    bucket begins is found beforehand, from one row per key and bucket.
    """
    wanted = F.struct(*[F.col(c) for c in columns])
    spread = F.concat(F.lit("\u0000"), F.spark_partition_id().cast("string"))
    usable = F.col(key).isNotNull() & F.col(at).isNotNull()
    # A stand-in no id can equal keeps rows that match nothing from piling up in one task.
    probes = rows.select(
        F.when(usable, F.col(key).cast("string")).otherwise(spread).alias("_key"),
        F.when(usable, _bucket(at, bucket_seconds)).alias("_bucket"),
        F.when(usable, F.col(at).cast("timestamp_ntz")).alias("_time"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
        usable.alias("_usable"),
    )
    held = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).cast("string").alias("_key"),
        _bucket(valid_from, bucket_seconds).alias("_bucket"),
        F.col(valid_from).cast("timestamp_ntz").alias("_time"),
        wanted.alias("_version"),
    )
    # The last version of each bucket, carried to the buckets in which rows ask.
    closing = first_per_key(held, ["_key", "_bucket"], [F.col("_time").desc(), F.col("_version").desc()])
    asked = probes.where("_usable").select("_key", "_bucket").distinct()
    no_version = F.lit(None).cast(held.schema["_version"].dataType)
    upto = Window.partitionBy("_key").orderBy("_bucket", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opening = (
        asked.select("_key", "_bucket", F.lit(0).alias("_kind"), no_version.alias("_version"))
        .unionByName(closing.select("_key", "_bucket", F.lit(1).alias("_kind"), "_version"))
        .withColumn("_version", F.last("_version", ignorenulls=True).over(upto))
        .where((F.col("_kind") == 0) & F.col("_version").isNotNull())
    )
    no_row = F.lit(None).cast(probes.schema["_row"].dataType)
    no_time = F.lit(None).cast("timestamp_ntz")
    line = ["_key", "_bucket", "_time", "_place", "_version", "_row"]
    laid = (
        opening.select("_key", "_bucket", no_time.alias("_time"), F.lit(0).alias("_place"), "_version", no_row.alias("_row"))
        .unionByName(held.select("_key", "_bucket", "_time", F.lit(1).alias("_place"), "_version", no_row.alias("_row")))
        .unionByName(probes.select("_key", "_bucket", "_time", F.lit(2).alias("_place"), no_version.alias("_version"), "_row"))
        .select(*line)
    )
    # Times without a value come first: that is where a bucket's opening version stands.
    forward = (
        Window.partitionBy("_key", "_bucket").orderBy("_time", "_place", "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = laid.withColumn("_valid", F.last("_version", ignorenulls=True).over(forward)).where("_place = 2")
    return found.select("_row.*", *[F.col("_valid")[c].alias(f"{prefix}{c}") for c in columns])
