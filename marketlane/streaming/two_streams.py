"""Item and order facts from two streams that arrive in any order.

An item may come before its order or after it, in another batch.  Items wait for
their order, and orders for their items, in the state of a stream-stream join:
both sides have a watermark on their own time, and an item belongs to an order only
within ``reach`` of the order's time, so Spark can drop what can find no partner any
more.  State is bounded by the rows of that time span, not by the history.  It lies in
RocksDB on the executors' disks, as ``reach`` may span years: kept as objects, twice the
state would have to fit into memory, that of the last batch and that of the one before.
On disk it lies twice, in the executors' files and in the checkpoint, hence the closer compression.
Rows that come even later are left to the daily run, which replaces whole slices.

Item counts per order are partial sums per batch, merged by the reader.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlane.plans import facts
from marketlane.streaming import incremental


#: State on disk; what it caches and has not yet flushed shares one limit on an executor.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Rows are mostly padding and repeated keys; larger blocks hold more of what repeats.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "16",
    # Four stores a partition, and each would set megabytes aside for logs that stay empty.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB; one with a checkpoint keeps the store it began with."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def items_with_orders(items: DataFrame, orders: DataFrame, item_time: str, reach: str, lateness: str) -> DataFrame:
    """Core items with ``user_id`` and ``order_created_at`` of their order, as a stream.

    ``item_time`` is when an item was delivered; a watermark needs a zoned time, hence the casts.
    """
    left = items.withColumn("_item_time", F.col(item_time).cast("timestamp")).withWatermark("_item_time", lateness)
    right = orders.select(
        F.col("order_id").alias("_order"), "user_id", F.col("created_at").alias("order_created_at"), F.col("created_at").cast("timestamp").alias("_order_time")
    ).withWatermark("_order_time", lateness)
    span = F.expr(f"interval {reach}")
    near = (F.col("_item_time") >= F.col("_order_time") - span) & (F.col("_item_time") <= F.col("_order_time") + span)
    joined = left.join(right, (F.col("order_id") == F.col("_order")) & near)
    return joined.drop("_order", "_order_time", "_item_time")


def items_fact(
    items: DataFrame, orders: DataFrame, products: DataFrame, categories: DataFrame, item_time: str, reach: str, lateness: str
) -> DataFrame:
    """``order_items_fact`` of two streams and the static product and category tables."""
    placed = items_with_orders(items, orders, item_time, reach, lateness)
    return facts.named_items(placed, products, categories)


def run_item_ingest(rows: DataFrame, root: str, checkpoint: str):
    """Append the fact and its marts; returns the finished query, whose progress tells the size of the state."""
    with state_on_disk(rows.sparkSession):
        return incremental.run_fact_ingest(rows, "order_items_fact", root, checkpoint)


def items_per_order(items_fact_rows: DataFrame, *by: str) -> DataFrame:
    """Partial item counts; add them up per order."""
    return items_fact_rows.groupBy("order_id", *by).agg(F.count("*").alias("items"))


def orders_fact_merge(orders: DataFrame, users: DataFrame, counts: DataFrame) -> DataFrame:
    """``orders_fact`` of the orders that have arrived, with the items that have arrived by now."""
    whole = counts.groupBy("order_id").agg(F.sum("items").alias("items"))
    bare = facts.orders_fact(orders, users, orders.select("order_id").limit(0)).drop("items_count")
    columns = [c for c in bare.columns]
    at = columns.index("acquisition_channel")
    joined = bare.join(whole, "order_id", "left").withColumn("items_count", F.coalesce("items", F.lit(0)).cast("int"))
    return joined.select(*columns[:at], "items_count", *columns[at:])
