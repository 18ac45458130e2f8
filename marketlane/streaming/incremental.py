"""Mart maintenance as rows arrive.

Two forms.  ``run_funnel_stream`` keeps running totals per day in stream state
and replaces the days that changed.  ``run_fact_ingest`` keeps no state: each
micro-batch adds partial mart rows under its own batch number, and readers
merge them.  Neither drops late rows: state is one row per day, so no watermark
is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlane.functions.dates import yyyymm
from marketlane.plans import marts
from marketlane.schemas import FACT_DAY_COLUMN, FACT_SORT_KEY, FACT_TABLES, MARTS
from marketlane.sinks.tables import replace_slices
from marketlane.sources import storage


def _drain(writer, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, then stop; a restart continues from the checkpoint."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def funnel_totals(events: DataFrame) -> DataFrame:
    """Running counters per day of a stream of events."""
    return events.groupBy(F.to_date("created_at").alias("day")).agg(*marts.event_counters())


def run_funnel_stream(events: DataFrame, mart: str, checkpoint: str) -> None:
    def write(changed: DataFrame, batch_id: int) -> None:
        # A changed day carries its new total, so writing it again is harmless.
        replace_slices(changed.withColumn("ds", F.col("day")), mart, ["ds"])

    writer = funnel_totals(events).writeStream.outputMode("update").foreachBatch(write)
    _drain(writer, checkpoint)


# Marts that an insert into a fact feeds.
MARTS_OF = {
    "orders_fact": {"daily_gmv": marts.daily_gmv},
    "order_items_fact": {
        "category_revenue_daily": marts.category_revenue_daily,
        "user_category_first_buy": marts.user_category_first_buy,
    },
    "events_fact": {"funnel_daily": marts.funnel_daily, "session_funnel_cells": marts.session_funnel_cells},
}


def run_fact_ingest(rows: DataFrame, table: str, root: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of fact rows and the partial rows of its marts below ``root``.

    Partitions are named by the batch, so a retried batch overwrites its own.
    Marts are computed from the written slice, not from the source again.
    """
    spark = rows.sparkSession
    ts = FACT_DAY_COLUMN[table]

    def write(batch: DataFrame, batch_id: int) -> None:
        laid_out = (
            batch.withColumns({"batch": F.lit(batch_id), "month": yyyymm(ts)})
            .hint("rebalance", "month")
            .sortWithinPartitions("month", *FACT_SORT_KEY[table])
        )
        fact = f"{root}/{table}"
        if not replace_slices(laid_out, fact, ["batch", "month"]):
            return  # a batch that only moves a watermark has no rows and no folder
        layout = f"{FACT_TABLES[table]}, batch bigint, month int"
        # Only the directory of the batch is listed, however many there are.
        written = spark.read.schema(layout).option("basePath", fact).parquet(f"{fact}/batch={batch_id}")
        for mart, build in MARTS_OF[table].items():
            partial = build(written).withColumn("batch", F.lit(batch_id))
            replace_slices(partial, f"{root}/{mart}", ["batch"])

    return _drain(rows.writeStream.foreachBatch(write), checkpoint)


# Partial rows of one key to one, still as the mart stores them.
COLLAPSE = {
    "daily_gmv": marts.daily_gmv_collapse,
    "category_revenue_daily": lambda r: marts.category_revenue_merge(r).withColumn("revenue", F.col("revenue").cast("decimal(18,2)")),
    "user_category_first_buy": lambda r: r.groupBy("user_id", "category_id").agg(F.min("first_buy_state").alias("first_buy_state")),
    "funnel_daily": marts.funnel_merge,
    "session_funnel_cells": marts.session_funnel_collapse,
}


def compact(spark: SparkSession, table: str, root: str) -> None:
    """Merge the batches of a fact and of its marts into the newest one; readers see the same totals.

    Runs while no ingest does.  The merged rows are written aside first, under
    the number of the newest batch.  A run that finds such a folder finishes it
    instead of merging anew, so one that was cut off does no harm.
    """
    for name in (table, *MARTS_OF[table]):
        path, aside = f"{root}/{name}", f"{root}/_compact_{name}"
        batches = sorted(int(c.removeprefix("batch=")) for c in storage.children(spark, path) if c.startswith("batch="))
        begun = [c for c in storage.children(spark, aside) if storage.exists(spark, f"{aside}/{c}/_SUCCESS")]
        if not begun and len(batches) < 2:
            continue
        layout = f"{FACT_TABLES[table]}, month int" if name == table else MARTS[name]
        if not begun:
            rows = spark.read.schema(f"{layout}, batch bigint").parquet(path).drop("batch")
            if name == table:
                merged = rows.hint("rebalance", "month").sortWithinPartitions("month", *FACT_SORT_KEY[table])
            else:
                merged = COLLAPSE[name](rows)
            merged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{aside}/{batches[-1]}")
            begun = [str(batches[-1])]
        newest = int(begun[0])
        kept = spark.read.schema(layout).parquet(f"{aside}/{newest}").withColumn("batch", F.lit(newest).cast("bigint"))
        storage.delete(spark, f"{path}/batch={newest}")
        replace_slices(kept, path, ["batch", *(["month"] if name == table else [])])
        for batch in batches:
            if batch < newest:
                storage.delete(spark, f"{path}/batch={batch}")
        storage.delete(spark, aside)


def dedup_stream(events: DataFrame, delay: str) -> DataFrame:
    """Optional: drop repeated deliveries that arrive within ``delay`` of each other.

    A watermark needs a zoned timestamp, hence the cast of the event time.
    """
    timed = events.withColumn("event_time", F.col("created_at").cast("timestamp"))
    key = ["user_id", "session_id", "product_id", "event_type", "event_time"]
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(key).drop("event_time")
