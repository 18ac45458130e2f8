"""CSV landing zone: everything is text and no row is refused.

Two layouts are read, and told apart by the folder ``root/orders``.  ``day``: ``root/YYYY-MM-DD/orders.csv`` with
``root/categories.csv``.  ``entity``: ``root/orders/_source_date=YYYY-MM-DD/*.csv``,
which is what Spark writes.

Quoted fields may hold newlines, and a row with too many or too few fields fails
the read.  Files larger than one split are cut into records by ``split_csv``, in as
many tasks as they have splits; smaller ones are parsed whole, one task each.  A feed
that is known to have no newlines in fields can be read with ``multi_line=False``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marketlane.operators.quality import union_all
from marketlane.schemas import DIMENSIONS, FACTS, LANDING_COLUMNS, landing_schema
from marketlane.sources import split_csv, storage

COUNTED = (*DIMENSIONS, *FACTS, "events")
DAY_PATTERN = r"(\d{4}-\d{2}-\d{2})/[^/]+$"
PARTITION_PATTERN = r"/_source_date=(\d{4}-\d{2}-\d{2})/"
# Quotes inside quoted fields are doubled.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "encoding": "UTF-8",
    # All columns are parsed, so that a wrong number of fields is seen whatever is selected.
    "mode": "FAILFAST", "columnPruning": "false",
}


def csv_options(multi_line: bool = True) -> dict[str, str]:
    return CSV_OPTIONS | {"multiLine": str(multi_line).lower()}


def stamp(rows: DataFrame, source_date, loaded_at: datetime, batch_id: str) -> DataFrame:
    """Add the lineage columns."""
    return rows.withColumns(
        {
            "_source_date": source_date,
            "_loaded_at": F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz"),
            "_batch_id": F.lit(batch_id),
        }
    )


def empty_landing(spark: SparkSession, entity: str) -> DataFrame:
    return spark.createDataFrame([], landing_schema(entity))


def _by_entity(spark: SparkSession, root: str) -> bool:
    """Does the landing zone have a folder per entity?"""
    return storage.exists(spark, f"{root}/orders")


def _entity_days(spark: SparkSession, root: str, folder: str, partition: str = "_source_date") -> set[str]:
    names = storage.children(spark, f"{root}/{folder}")
    return {n.removeprefix(f"{partition}=") for n in names if n.startswith(f"{partition}=")}


def day_partitions(spark: SparkSession, root: str) -> list[str]:
    """Days that have a directory, from the listing alone."""
    if _by_entity(spark, root):
        return sorted(set().union(*(_entity_days(spark, root, e) for e in COUNTED if e != "categories")))
    return [n for n in storage.children(spark, root) if len(n) == 10 and n[4] == n[7] == "-"]


def days_with(spark: SparkSession, root: str, name: str, days: Sequence[str]) -> list[str]:
    """Those of ``days`` that hold a file ``name``, by one listing."""
    if _by_entity(spark, root):
        folder = name.split(".")[0]
        found = _entity_days(spark, root, folder, "ds" if folder == "manifest" else "_source_date")
        return [ds for ds in days if ds in found]
    found = {path.rsplit("/", 2)[1] for path in storage.matching(spark, f"{root}/*/{name}")}
    return [ds for ds in days if ds in found]


def read_csv(
    spark: SparkSession, entity: str, path: str | Sequence[str], multi_line: bool = True, split: bool | None = None
) -> DataFrame:
    """All-text rows of CSV files.  ``split`` says whether records are cut in parallel; by default, if any file needs it."""
    return _scan(spark, landing_schema(entity), path, multi_line, split).drop("_file")


def _scan(spark: SparkSession, schema: T.StructType, path: str | Sequence[str], multi_line: bool = True, split: bool | None = None) -> DataFrame:
    """Rows with the ``_file`` they come from."""
    paths = [path] if isinstance(path, str) else list(path)
    if multi_line and (split_csv.worth_it(spark, paths) if split is None else split):
        return split_csv.read(spark, schema, paths, CSV_OPTIONS)
    rows = spark.read.schema(schema).options(**csv_options(multi_line)).csv(paths)
    return rows.withColumn("_file", F.col("_metadata.file_path"))


def _of_day_folder(rows: DataFrame) -> DataFrame:
    """``_source_date`` instead of the file."""
    return rows.withColumn("_source_date", F.to_date(F.regexp_extract("_file", DAY_PATTERN, 1))).drop("_file")


def _of_partition(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_source_date", F.to_date(F.regexp_extract("_file", PARTITION_PATTERN, 1))).drop("_file")


def _day_folders(spark: SparkSession, root: str, folder: str, days: Sequence[str]) -> list[str]:
    present = _entity_days(spark, root, folder)
    return [f"{root}/{folder}/_source_date={d}" for d in days if d in present]


def read_entity(
    spark: SparkSession,
    root: str,
    entity: str,
    loaded_at: datetime,
    batch_id: str,
    days: Sequence[str],
) -> DataFrame:
    """Landed rows of one entity for the given days; only their files are read.

    A file that is missing inside a day counts as no rows.  Categories have no
    day: the root file is re-read each run and stamped with the run's first day.
    """
    if _by_entity(spark, root):
        if entity == "categories":
            rows = read_entity_layout(spark, root, entity, loaded_at, batch_id)
            return rows.withColumn("_source_date", F.lit(min(days)).cast("date"))
        return read_entity_layout(spark, root, entity, loaded_at, batch_id, days)
    if entity == "categories":
        paths = storage.matching(spark, f"{root}/categories.csv")
    else:
        paths = [f"{root}/{ds}/{entity}.csv" for ds in days_with(spark, root, f"{entity}.csv", days)]
    if not paths:
        return stamp(empty_landing(spark, entity), F.lit(None).cast("date"), loaded_at, batch_id)
    rows = _of_day_folder(_scan(spark, landing_schema(entity), paths))
    day = F.lit(min(days)).cast("date") if entity == "categories" else F.col("_source_date")
    return stamp(rows, day, loaded_at, batch_id)


def _one_of(column: str, days: Sequence[str]):
    return F.col(column).isin([datetime.fromisoformat(d).date() for d in days])


def read_entity_layout(
    spark: SparkSession, root: str, entity: str, loaded_at: datetime, batch_id: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Rows written by ``write_landing``, of all days or of those given; only their directories are read."""
    path = f"{root}/{entity}"
    if not storage.exists(spark, path):
        return stamp(empty_landing(spark, entity), F.lit(None).cast("date"), loaded_at, batch_id)
    paths = [path] if days is None else _day_folders(spark, root, entity, days)
    if paths and split_csv.worth_it(spark, paths):
        found = _of_partition(split_csv.read(spark, landing_schema(entity), paths, CSV_OPTIONS))
        return stamp(found, F.col("_source_date"), loaded_at, batch_id)
    schema = landing_schema(entity).add("_source_date", T.DateType())
    rows = spark.read.schema(schema).options(**csv_options()).csv(path)
    if days is not None:
        rows = rows.where(_one_of("_source_date", days))
    return stamp(rows, F.col("_source_date"), loaded_at, batch_id)


def read_monolith(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """One CSV per entity without day directories."""
    return read_csv(spark, entity, f"{root}/{entity}.csv")


def _typed_events_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField(c, T.TimestampNTZType() if c == "created_at" else T.StringType())
            for c in LANDING_COLUMNS["events"]
        ]
    )


def read_typed_events(spark: SparkSession, path: str | Sequence[str], split: bool | None = None) -> DataFrame:
    """Events go straight to the fact table, so their time is typed by the scan; a bad time fails."""
    return _scan(spark, _typed_events_schema(), path, split=split).drop("_file")


def read_events_of_days(spark: SparkSession, root: str, days: Sequence[str]) -> DataFrame:
    """Typed events of the given days, which all have a file, with their ``_source_date``."""
    if _by_entity(spark, root):
        paths = _day_folders(spark, root, "events", days)
        if paths and split_csv.worth_it(spark, paths):
            return _of_partition(split_csv.read(spark, _typed_events_schema(), paths, CSV_OPTIONS))
        schema = _typed_events_schema().add("_source_date", T.DateType())
        rows = spark.read.schema(schema).options(**csv_options()).csv(f"{root}/events")
        return rows.where(_one_of("_source_date", days))
    return _of_day_folder(_scan(spark, _typed_events_schema(), [f"{root}/{ds}/events.csv" for ds in days]))


def stream_typed_events(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """The same scan as a file stream over all day partitions, present and to come."""
    reader = spark.readStream.schema(_typed_events_schema()).options(**csv_options())
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(f"{root}/*/events.csv")


def stream_entity_events(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """The entity layout as a file stream, with its ``_source_date``."""
    schema = _typed_events_schema().add("_source_date", T.DateType())
    return spark.readStream.schema(schema).options(**csv_options()).option("maxFilesPerTrigger", files_per_batch).csv(f"{root}/events")


def read_manifest(spark: SparkSession, root: str, days: Sequence[str]) -> DataFrame:
    """Announced row counts as ``source_date, source_table, rows_manifest``."""
    if _by_entity(spark, root) and days_with(spark, root, "manifest.json", days):
        return read_written_manifests(spark, root).where(_one_of("source_date", days))
    paths = [f"{root}/{ds}/manifest.json" for ds in days_with(spark, root, "manifest.json", days)]
    if not paths:
        return spark.createDataFrame([], "source_date date, source_table string, rows_manifest bigint")
    schema = T.StructType([T.StructField(e, T.LongType()) for e in COUNTED])
    wide = spark.read.schema(schema).option("multiLine", "true").json(paths)
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), DAY_PATTERN, 1))
    return unpivot_counts(wide.select(day.alias("source_date"), *COUNTED))


def read_written_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Counts written by ``write_manifests`` as ``source_date, source_table, rows_manifest``."""
    schema = ", ".join(f"{e} bigint" for e in COUNTED) + ", ds date"
    wide = spark.read.schema(schema).json(f"{root}/manifest")
    return unpivot_counts(wide.withColumnRenamed("ds", "source_date"))


def unpivot_counts(wide: DataFrame) -> DataFrame:
    """One line per entity that a manifest mentions."""
    pairs = ", ".join(f"'{e}', {e}" for e in COUNTED)
    return wide.select(
        "source_date", F.expr(f"stack({len(COUNTED)}, {pairs}) as (source_table, rows_manifest)")
    ).where(F.col("rows_manifest").isNotNull())


def landed_counts(landed: dict[str, DataFrame]) -> DataFrame:
    """Rows that landed per table and day, in one job over all tables."""
    slim = [f.select(F.lit(e).alias("source_table"), "_source_date") for e, f in landed.items()]
    return (
        union_all(slim)
        .groupBy(F.col("_source_date").alias("source_date"), "source_table")
        .agg(F.count("*").alias("rows_staging"))
    )
