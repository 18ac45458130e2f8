"""Landing days as a stream, audited batch by batch against their manifests.

``run_audited_events`` appends a stream of typed events.  Each batch first counts what
it wrote per day; a day is closed once a later day has begun, and a closed day that
has fewer rows than its manifest announced stops the query before the batch is committed.
Its slice is taken back, an audit line names the day, and a restart tries the batch again.

``BatchLog`` is a listener that keeps the metrics observed of every batch, and the
reason when a query ends by a failure.
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from marketlane.operators import quality
from marketlane.plans import facts
from marketlane.schemas import FACT_TABLES
from marketlane.sinks.tables import append, replace_slices
from marketlane.sources import landing, storage

AUDIT = "source_date date, source_table string, batch bigint, rows_staging bigint, rows_manifest bigint, status string"
LOG = "query string, batch bigint, rows bigint, first_day date, last_day date, state_rows bigint, outcome string, seen_at timestamp_ntz"
METRICS = "landed"


class BatchLog(StreamingQueryListener):
    """Writes one line per batch that saw rows, and one for the end of each query, to ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}

    def _line(self, query: str, batch: int | None, rows: int | None, first, last, state: int | None, outcome: str) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        append(self.spark.createDataFrame([(query, batch, rows, first, last, state, outcome, now)], LOG), self.path)

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRICS)
        if seen is not None and seen["rows"]:
            state = sum(s.numRowsTotal for s in progress.stateOperators)
            self._line(progress.name or str(progress.id), progress.batchId, seen["rows"], seen["first_day"], seen["last_day"], state, "success")

    def onQueryTerminated(self, event) -> None:
        outcome = "complete" if event.exception is None else f"failed: {event.exception.splitlines()[0][:500]}"
        self._line(str(event.id), None, None, None, None, None, outcome)
        self._end(str(event.runId)).set()

    def wait_for(self, run: str, seconds: float = 60.0) -> bool:
        """Until the end of a run has been logged: the listener works behind the query."""
        return self._end(run).wait(seconds)


def observed(rows: DataFrame, day: str = "_source_date") -> DataFrame:
    """The stream with its metrics per batch."""
    return rows.observe(METRICS, F.count(F.lit(1)).alias("rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def stream_days(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Typed events of all days, present and to come, with their ``_source_date``; either landing layout."""
    if storage.exists(spark, f"{root}/events"):
        return landing.stream_entity_events(spark, root, files_per_batch)
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), landing.DAY_PATTERN, 1))
    return landing.stream_typed_events(spark, root, files_per_batch).withColumn("_source_date", day)


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    if storage.exists(spark, f"{root}/manifest"):
        return landing.read_written_manifests(spark, root)
    return landing.read_manifest(spark, root, landing.day_partitions(spark, root))


def _closed_short(counts: DataFrame, manifest: DataFrame, table: str, finish: bool) -> DataFrame:
    """Days that can't grow any more and have fewer rows than announced."""
    staged = counts.groupBy("source_date", "source_table").agg(F.sum("rows_staging").alias("rows_staging"))
    announced = manifest.where(F.col("source_table") == table)
    if not finish:
        newest = counts.agg(F.max("source_date")).first()[0]
        announced = announced.where(F.col("source_date") < F.lit(newest))
    first = counts.agg(F.min("source_date")).first()[0]
    return quality.shortfalls(staged, announced.where(F.col("source_date") >= F.lit(first)))


def run_audited_events(spark: SparkSession, raw: str, root: str, checkpoint: str, files_per_batch: int = 1000, finish: bool = True) -> BatchLog:
    """Append the events of all days below ``root/events_fact`` and audit them in ``root/stream_audit``.

    With ``finish`` the last day counts as closed when all that has arrived is
    processed.  Raises ``QualityError`` when rows were lost.  Repeating it goes
    on after the last good batch.
    """
    table, fact, audit = "events_fact", f"{root}/events_fact", f"{root}/stream_audit"
    layout = f"{FACT_TABLES[table]}, _source_date date, batch bigint"
    lost: list[str] = []  # the callback's own words; the query wraps them

    def lines_before(batch_id: int) -> DataFrame:
        if not storage.exists(spark, audit):
            return spark.createDataFrame([], AUDIT)
        return spark.read.schema(AUDIT).parquet(audit).where((F.col("batch") < batch_id) & (F.col("status") == "success"))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = facts.events_fact(batch, keep=("_source_date",)).withColumn("batch", F.lit(batch_id).cast("bigint"))
        replace_slices(rows, fact, ["batch"])
        landed = f"{fact}/batch={batch_id}"
        if not storage.exists(spark, landed):
            return
        written = spark.read.schema(layout).option("basePath", fact).parquet(landed)
        days = written.groupBy(F.col("_source_date").alias("source_date")).agg(F.count("*").alias("rows_staging"))
        counts = days.select("source_date", F.lit("events").alias("source_table"), F.lit(batch_id).cast("bigint").alias("batch"), "rows_staging")
        manifest = _manifest(spark, raw)
        so_far = lines_before(batch_id).select(*counts.columns).unionByName(counts)
        short = _closed_short(so_far, manifest, "events", False).collect()
        status = F.lit("success")
        if short:
            status = F.when(F.col("source_date").isin([r["source_date"] for r in short]), "short").otherwise("taken_back")
        lines = counts.join(manifest, ["source_date", "source_table"], "left").withColumn("status", status)
        missing = [(r["source_date"], "events", batch_id, r["rows_staging"], r["rows_manifest"], "short") for r in short]
        own = lines.select("source_date", "source_table", "batch", "rows_staging", "rows_manifest", "status")
        named = spark.createDataFrame(missing, AUDIT).join(own.select("source_date"), "source_date", "left_anti") if missing else None
        own = own if named is None else own.unionByName(named.select(*own.columns))
        replace_slices(own.withColumn("slice", F.lit(batch_id)), audit, ["slice"])
        if short:
            storage.delete(spark, landed)
            lost.append(f"rows lost in batch {batch_id}: {_named(short)}")
            raise quality.QualityError(lost[-1])

    log = BatchLog(spark, f"{root}/stream_log")
    spark.streams.addListener(log)
    try:
        query = (
            observed(stream_days(spark, raw, files_per_batch))
            .writeStream.queryName("audited_events")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run = str(query.runId)
        try:
            query.awaitTermination()
        except Exception as error:
            if lost:
                raise quality.QualityError(lost[-1]) from error
            raise
        finally:
            log.wait_for(run)
    finally:
        spark.streams.removeListener(log)
    if finish and storage.exists(spark, audit):
        counts = lines_before(1 << 62)
        manifest = _manifest(spark, raw)
        short = _closed_short(counts, manifest, "events", True).collect()
        if short:
            raise quality.QualityError(f"rows lost: {_named(short)}")
    return log


def _named(short) -> str:
    return ", ".join(f"{r['source_date']} has {r['rows_staging']} of {r['rows_manifest']} rows" for r in short)
