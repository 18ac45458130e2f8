"""One survivor per key, with groups of copies of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

FIRST = "first"          # the row that keeps the key
SAME_RUN = "same_run"    # another copy delivered by the same run
LATER_RUN = "later_run"  # first copy of a later run: the key is already taken


def total_order(rows: DataFrame, key: Sequence[str], first: Sequence[str | Column]) -> list[Column]:
    """``first``, then every other column outside the key, so that only equal rows can tie."""
    named = [c for c in first if isinstance(c, str)]
    rest = [c for c in rows.columns if c not in key and c not in named]
    return [*first, *rest]


def first_per_key(rows: DataFrame, key: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep one row per key.

    The ``= 1`` filter lets Spark prune every map task to one row per key
    before the shuffle, so a hot key never reaches a single task whole.
    """
    w = Window.partitionBy(*key).orderBy(*total_order(rows, key, order_by))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def mark_first(
    rows: DataFrame, group: str, key: str, order_by: Sequence[str | Column], eligible: Column, out: str
) -> DataFrame:
    """Add boolean ``out``: is the row the first eligible one of its key within its group?

    Rows that are already dealt out by ``group`` are not moved.  The first of a key
    over all groups is one of the rows marked.
    """
    ordered = [~F.coalesce(eligible, F.lit(False)), *total_order(rows, [group, key], order_by)]
    w = Window.partitionBy(group, key).orderBy(*ordered)
    return rows.withColumn(out, (F.row_number().over(w) == 1) & F.coalesce(eligible, F.lit(False)))


def latest_version(rows: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Replacing collapse: the row with the highest version per key."""
    return first_per_key(rows, key, [F.col(version).desc()])


def copied_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, counted before the shuffle, so this moves keys and no rows."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return counted.where("_n > 1").select(key)


def part_by_copies(rows: DataFrame, key: str, copied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are alone with their key, and the others, rows without a key among them.

    ``copied`` are the stored ``copied_keys``: while these are few, Spark broadcasts them and no row moves.
    """
    flagged = rows.join(copied.select(F.col(key).alias("_copied")), F.col(key) == F.col("_copied"), "left")
    several = F.col(key).isNull() | F.col("_copied").isNotNull()
    return flagged.where(~several).drop("_copied"), flagged.where(several).drop("_copied")


def mark_copies(
    rows: DataFrame,
    key: Sequence[str],
    run: Sequence[str],
    order_by: Sequence[str | Column],
    eligible: Column,
    salts: int | None = None,
) -> DataFrame:
    """Add ``copy_state`` to eligible rows (NULL on the others) and keep all rows.

    Two steps.  Each (key, run) is first ranked per salt, the salt being the
    input task, so a hot key is spread over ``salts`` groups, by default as many
    as the session has shuffle partitions.  Then only the best row of each salt
    meets its rivals: at most ``salts`` rows per key and run.  The other rows
    stay in their own salted group.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = total_order(rows, [*key, *run], order_by)
    salted = rows.withColumns(
        {
            "_eligible": F.coalesce(eligible, F.lit(False)),
            "_salt": F.pmod(F.spark_partition_id(), F.lit(salts)),
        }
    )
    local = Window.partitionBy(*key, *run, "_eligible", "_salt").orderBy(*ordered)
    ranked = salted.withColumn("_local", F.row_number().over(local)).withColumn(
        "_group", F.when(F.col("_eligible") & (F.col("_local") == 1), -1).otherwise(F.col("_salt"))
    )
    overall = Window.partitionBy(*key, "_eligible", "_group").orderBy(*run, *ordered)
    run_id = F.struct(*run) if run else F.lit(0)
    return (
        ranked.withColumn("_rank", F.row_number().over(overall))
        .withColumn("_previous_run", F.lag(run_id).over(overall))
        .withColumn(
            "copy_state",
            F.when(~F.col("_eligible"), F.lit(None).cast("string"))
            .when(F.col("_group") != -1, SAME_RUN)
            .when(F.col("_rank") == 1, FIRST)
            .when(F.col("_previous_run") == run_id, SAME_RUN)
            .otherwise(LATER_RUN),
        )
        .drop("_eligible", "_salt", "_local", "_group", "_rank", "_previous_run")
    )
