"""Prioritised reject reasons and key lookups that feed them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Reason of the first rule that holds, NULL when none does."""
    (reason, condition), *rest = rules
    case = F.when(condition, reason)
    for reason, condition in rest:
        case = case.when(condition, reason)
    return case


def first_seen(rows: DataFrame, key: str, arrival: str = "_source_date") -> DataFrame:
    """Each key with the day it first arrived, ready to be joined with a hot key on the other side."""
    return skew_ready(rows.groupBy(key).agg(F.min(arrival).alias("first_ds")))


def skew_ready(keyed: DataFrame) -> DataFrame:
    """Side of a join that was folded by the join key, put behind an exchange of its own.

    A grouped frame would feed the join without a further exchange, and adaptive
    execution only splits a hot key of the other side when both sides have one.
    """
    return keyed.hint("rebalance")


def unknown_keys(rows: DataFrame, column: str, known: DataFrame, key: str, arrival: str) -> DataFrame:
    """``column, arrival`` of ``rows``, each pair once, where the key is not known by that day.

    ``known`` as for ``lookup_key``.  Pairs are folded before the shuffle, so this moves keys and no rows.
    """
    asked = rows.where(F.col(column).isNotNull()).select(column, arrival).distinct()
    first = known.select(F.col(key).alias("_key"), F.col("first_ds").alias("_first_ds"))
    joined = asked.join(first, F.col(column) == F.col("_key"), "left")
    return joined.where(F.col("_key").isNull() | (F.col("_first_ds") > F.col(arrival))).select(column, arrival)


def lookup_unknown(rows: DataFrame, column: str, unknown: DataFrame, out: str, arrival: str) -> DataFrame:
    """``lookup_key`` by the stored pairs of ``unknown_keys``: while these are few, Spark broadcasts them and no row moves."""
    spread = F.concat(F.lit("\u0000"), F.spark_partition_id().cast("string"))
    left = rows.withColumn("_probe", F.coalesce(F.col(column), spread))
    right = unknown.select(F.col(column).alias("_key"), F.col(arrival).alias("_day"))
    joined = left.join(right, (F.col("_probe") == F.col("_key")) & F.col(arrival).eqNullSafe(F.col("_day")), "left")
    return joined.withColumn(out, F.col(column).isNotNull() & F.col("_key").isNull()).drop("_probe", "_key", "_day")


def lookup_key(
    rows: DataFrame, column: str, known: DataFrame, key: str, out: str, arrival: str | None, probe: bool = False
) -> DataFrame:
    """Add boolean ``out``: is ``column`` a known key, as of the row's ``arrival`` day?

    ``known`` holds unique keys and their ``first_ds``, as a scan or ``skew_ready``;
    with ``arrival=None`` the day is not compared.  Rows without a key get a spread-out stand-in that
    no id can equal (ids never contain NUL), so missing keys do not pile up in one task.  With
    ``probe`` the joined text stays as ``_probe``: rows that are grouped by it next stay where they are.
    """
    spread = F.concat(F.lit("\u0000"), F.spark_partition_id().cast("string"))
    # The probe moves in place of the column, which is read off it again.
    left = rows.withColumn("_probe", F.coalesce(F.col(column).cast("string"), spread)).drop(column)
    right = known.select(F.col(key).cast("string").alias("_key"), F.col("first_ds").alias("_first_ds"))
    told = F.when(~F.col("_probe").startswith("\u0000"), F.col("_probe")).cast(rows.schema[column].dataType).alias(column)
    joined = left.join(right, F.col("_probe") == F.col("_key"), "left").select(
        *[told if c == column else F.col(f"`{c}`") for c in rows.columns], "_probe", "_key", "_first_ds"
    )
    found = F.col("_key").isNotNull()
    if arrival:
        found = found & (F.col("_first_ds") <= F.col(arrival))
    return joined.withColumn(out, found).drop(*([] if probe else ["_probe"]), "_key", "_first_ds")
