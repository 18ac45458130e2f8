"""Writers: day slices, logs, CSV and manifests.

Plain parquet has no transactions: while a slice is being replaced a reader
may see it half done.  Writers of one table must not run at the same time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from marketlane.functions.dates import yyyymm
from marketlane.operators.quality import union_all
from marketlane.schemas import ETL_LOG, FACT_DAY_COLUMN, FACT_SORT_KEY, LANDING_COLUMNS
from marketlane.sources import storage
from marketlane.sources.landing import COUNTED


#: Files that one write may leave when its tasks write what they hold, without a shuffle that gathers each slice.
MOST_FILES = 50_000
#: Warehouse files are read often and written once.
CODEC = "zstd"


def gathered(rows: DataFrame, slices: int, *partition: str) -> DataFrame:
    """``rows`` as they are, or gathered by slice where every task writing a file of its own per slice would leave too many.

    The rebalance hint lets adaptive execution split a busy slice over several tasks and merge quiet ones into one.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.hint("rebalance", *partition) if slices * tasks > MOST_FILES else rows


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("compression", CODEC).parquet(path)


def append_counted(rows: DataFrame, path: str) -> int:
    """Append and return the number of rows, counted by the write itself."""
    seen = Observation()
    append(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def overwrite(rows: DataFrame, path: str) -> None:
    """Full replace of a table."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).parquet(path)


def replace_slices(
    rows: DataFrame,
    path: str,
    partition: Sequence[str],
    days: Sequence[str] | None = None,
    day: str = "ds",
) -> int:
    """Replace partitions of ``path`` by ``rows``; other partitions stay.

    ``days`` lists the slices that are being replaced.  Overwriting leaves a
    slice without new rows as it was, so those are removed here.  Returns the
    number of rows written, counted by the write itself.
    """
    spark = rows.sparkSession
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if days is not None:
        # At most one entry per listed day: a run replaces what it was asked to.
        metrics.append(F.collect_set(F.when(F.col(day).cast("string").isin(list(days)), F.col(day).cast("string"))).alias("days"))
    (
        rows.observe(seen, *metrics)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partition)
        .parquet(path)
    )
    result = seen.get
    drop_slices(spark, path, day, set(days or ()) - set(result.get("days") or ()))
    return result["rows"]


def drop_slices(spark: SparkSession, path: str, day: str, values: set[str]) -> None:
    """Remove the partition directories of some days, below any leading partition; each folder is listed once."""
    gone = {f"{day}={value}" for value in values}
    if not gone:
        return
    found = storage.children(spark, path)
    leading = [f"{path}/{c}" for c in found if "=" in c and not c.startswith(f"{day}=")]
    for parent, names in [(path, found), *((p, storage.children(spark, p)) for p in leading)]:
        for name in gone.intersection(names):
            storage.delete(spark, f"{parent}/{name}")


def write_fact(
    rows: DataFrame, path: str, table: str, days: Sequence[str] | None = None, day: str | None = None
) -> int:
    """Month and day partitions, sorted inside, replaced day by day.

    The slice day is the event day, or column ``day`` where deliveries decide.
    Unless the slices are known to be few, each is gathered first.
    """
    slice_day = F.to_date(day or FACT_DAY_COLUMN[table])
    dated = rows.withColumns({"month": yyyymm(slice_day), "ds": slice_day})
    slices = MOST_FILES if days is None else len(days)
    laid_out = gathered(dated, slices, "month", "ds").sortWithinPartitions("month", "ds", *FACT_SORT_KEY[table])
    return replace_slices(laid_out, path, ["month", "ds"], days)


class RunLog:
    """Operations records of one run, appended in one write when the run ends, also a failed one."""

    def __init__(self, spark: SparkSession, path: str, dag: str, ds: str, ts: datetime):
        self.spark, self.path = spark, path
        self._head = (ts, dag)
        self._day = datetime.fromisoformat(ds).date()
        self._records: list[tuple] = []

    def add(self, task: str, table: str, rows: int, seconds: float, status: str = "success") -> None:
        ts, dag = self._head
        self._records.append((ts, dag, task, self._day, table, int(rows), float(seconds), status))

    def __enter__(self) -> RunLog:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self.add("run_failed", "ALL", 0, 0.0, "failed")
        append(self.spark.createDataFrame(self._records, ETL_LOG).coalesce(1), self.path)


def upsert_audit(audit: DataFrame, path: str, days: Sequence[str] | None = None) -> int:
    """Replace the audit lines of ``days``, or of the days in ``audit``: one line per day and table."""
    dated = audit.withColumn("ds", F.col("source_date")).hint("rebalance", "ds")
    return replace_slices(dated, path, ["ds"], days)


# Fields keep their own white space; the writer would trim it.
CSV_WRITE = {
    "header": "true", "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


#: Rows of one compressed landing file, which a reader can't split.
COMPRESSED_ROWS = 200_000


def write_landing(rows: DataFrame, root: str, entity: str, day, slices: int | None = None, compression: str = "none") -> None:
    """CSV per entity and day; dimensions are cut by the day they appeared.

    ``slices`` says how many days there are at most; where they are few, rows are not shuffled.
    """
    columns = LANDING_COLUMNS[entity]
    dated = rows.select(*columns, F.to_date(day).alias("_source_date"))
    (
        gathered(dated, MOST_FILES if slices is None else slices, "_source_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", 0 if compression == "none" else COMPRESSED_ROWS)
        .options(**CSV_WRITE)
        .partitionBy("_source_date")
        .csv(f"{root}/{entity}")
    )


def manifest_counts(frames: dict[str, tuple[DataFrame, object]]) -> DataFrame:
    """Row counts per day, one column per entity."""
    slim = [f.select(F.to_date(day).alias("ds"), F.lit(e).alias("entity")) for e, (f, day) in frames.items()]
    order = [e for e in COUNTED if e in frames]
    return union_all(slim).groupBy("ds").pivot("entity", order).agg(F.count("entity"))


def write_manifests(counts: DataFrame, root: str) -> None:
    """One JSON object per day; entities without rows are left out."""
    (
        counts.hint("rebalance", "ds")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "true")
        .partitionBy("ds")
        .json(f"{root}/manifest")
    )


def write_monolith(rows: DataFrame, root: str, entity: str, first: bool) -> None:
    """Append to one CSV table per entity, started anew by the first batch."""
    (
        rows.select(*LANDING_COLUMNS[entity])
        .write.mode("overwrite" if first else "append")
        .options(**CSV_WRITE)
        .csv(f"{root}/{entity}.csv")
    )
