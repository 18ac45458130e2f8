"""Facts from two streams in any order of arrival against the batch build."""

import glob
import random
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from marketlane.plans import facts, marts
from marketlane.streaming import two_streams

START = "2025-01-01 00:00:00"
ITEMS = "order_item_id string, order_id string, product_id string, quantity int, unit_price decimal(12,2), landed_at timestamp_ntz"
ORDERS = (
    "order_id string, user_id string, created_at timestamp_ntz, status string, payment_method string,"
    " total_amount decimal(12,2), discount_amount decimal(12,2)"
)


def at(hours):
    return F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=hours)


def make_orders(spark, rows):
    df = spark.createDataFrame(rows, "order_id string, user_id string, h int")
    return df.select(
        "order_id", "user_id", at(F.col("h")).alias("created_at"), F.lit("completed").alias("status"), F.lit("card").alias("payment_method"),
        F.lit(10).cast("decimal(12,2)").alias("total_amount"), F.lit(0).cast("decimal(12,2)").alias("discount_amount"),
    )


def make_items(spark, rows):
    df = spark.createDataFrame(rows, "order_item_id string, order_id string, product_id string, quantity int, h int")
    return df.select("order_item_id", "order_id", "product_id", "quantity", F.lit(2).cast("decimal(12,2)").alias("unit_price"), at(F.col("h")).alias("landed_at"))


@pytest.fixture
def lookups(spark):
    products = spark.sql("select 'p1' product_id, 1 category_id union all select 'p2', null")
    return products, spark.sql("select 1 category_id, 'c' name"), spark.sql("select 'u1' user_id, 'a' acquisition_channel, 'x' city, '18-24' age_group union all select 'u2', 'b', 'y', '45+'")


def stream(spark, folder, layout):
    return spark.readStream.schema(layout).option("maxFilesPerTrigger", 1).parquet(f"{folder}/b*")


def ingest(spark, tmp_path, orders, items, lookups, reach="3 days", lateness="1 day"):
    """One batch of each stream per round."""
    query = None
    for n in range(max(len(orders), len(items))):
        for name, parts in (("orders", orders), ("items", items)):
            if n < len(parts):
                parts[n].coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}/b{n}")
        left, right = stream(spark, f"{tmp_path}/items", ITEMS), stream(spark, f"{tmp_path}/orders", ORDERS)
        rows = two_streams.items_fact(left, right, *lookups[:2], "landed_at", reach, lateness)
        query = two_streams.run_item_ingest(rows, f"{tmp_path}/root", f"{tmp_path}/state")
    return query


def test_any_order_of_arrival_gives_the_batch_facts(spark, tmp_path, lookups):
    rng = random.Random(4)
    orders = [(f"o{k}", rng.choice(["u1", "u2"]), rng.randrange(0, 48)) for k in range(60)]
    hour = {o: h for o, _, h in orders}
    items = []
    for k in range(200):
        o = f"o{rng.randrange(66)}"  # some never have an order
        items.append((f"i{k}", o, rng.choice(["p1", "p2"]), rng.randrange(1, 4), max(0, hour.get(o, 20) + rng.randrange(-20, 20))))
    deal = lambda rows, n: [[r for r in rows if zlib.crc32(r[0].encode()) % n == p] or rows[:0] for p in range(n)]
    order_parts = [make_orders(spark, p) for p in deal(orders, 3) if p]
    item_parts = [make_items(spark, p) for p in deal(items, 4) if p]
    ingest(spark, tmp_path, order_parts, item_parts, lookups, "10 days", "10 days")
    products, categories, users = lookups
    all_orders, all_items = make_orders(spark, orders), make_items(spark, items)
    expected = facts.order_items_fact(all_items, all_orders, products, categories)
    got = spark.read.parquet(f"{tmp_path}/root/order_items_fact").drop("batch", "month")
    assert got.columns == expected.columns and sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    revenue = marts.category_revenue_merge(spark.read.parquet(f"{tmp_path}/root/category_revenue_daily"))
    assert sorted(map(repr, revenue.collect())) == sorted(map(repr, marts.category_revenue_merge(marts.category_revenue_daily(expected)).collect()))
    counts = two_streams.items_per_order(spark.read.parquet(f"{tmp_path}/root/order_items_fact"), "batch")
    assert counts.count() > counts.select("order_id").distinct().count()  # several batches added to one order
    merged = two_streams.orders_fact_merge(all_orders, users, counts)
    known = all_items.join(all_orders, "order_id", "left_semi")
    whole = facts.orders_fact(all_orders, users, known)
    assert merged.columns == whole.columns and sorted(map(repr, merged.collect())) == sorted(map(repr, whole.collect()))


def test_state_is_given_up_behind_the_watermark(spark, tmp_path, lookups):
    orders = [make_orders(spark, [(f"o{d}-{k}", "u1", 24 * d) for k in range(50)]) for d in range(0, 40, 8)]
    items = [make_items(spark, [(f"i{d}-{k}", f"o{d}-{k}", "p1", 1, 24 * d + 5) for k in range(50)]) for d in range(0, 40, 8)]
    query = ingest(spark, tmp_path, orders, items, lookups)
    assert spark.read.parquet(f"{tmp_path}/root/order_items_fact").count() == 250
    held = query.lastProgress.stateOperators[0].numRowsTotal
    assert held <= 200  # both sides of the newest days, of 500 rows in all


def test_unlimited_state_is_refused_by_the_plan(spark, tmp_path, lookups):
    make_orders(spark, [("o1", "u1", 1)]).write.parquet(f"{tmp_path}/orders/b0")
    make_items(spark, [("i1", "o1", "p1", 1, 2)]).write.parquet(f"{tmp_path}/items/b0")
    rows = two_streams.items_fact(stream(spark, f"{tmp_path}/items", ITEMS), stream(spark, f"{tmp_path}/orders", ORDERS), *lookups[:2], "landed_at", "3 days", "1 day")
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert plan.count("EventTimeWatermark") == 2


def test_state_lies_on_disk(spark, tmp_path, lookups):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    query = ingest(spark, tmp_path, [make_orders(spark, [("o1", "u1", 1)])], [make_items(spark, [("i1", "o1", "p1", 1, 2)])], lookups)
    assert "rocksdbPutCount" in query.recentProgress[0].stateOperators[0].customMetrics
    assert spark.conf.get(name) == before


def test_state_files_are_compressed_closely_and_set_no_space_aside(spark, tmp_path, lookups):
    before = {k: spark.conf.get(k, None) for k in two_streams.STATE_STORE}
    ingest(spark, tmp_path, [make_orders(spark, [("o1", "u1", 1)])], [make_items(spark, [("i1", "o1", "p1", 1, 2)])], lookups)
    files = glob.glob(f"{tmp_path}/state/state/0/*/*/1.zip")
    assert len(files) == 4 * 8  # four stores a partition
    for name in files:
        with zipfile.ZipFile(name) as file:
            options = next(file.read(n).decode() for n in file.namelist() if n.startswith("OPTIONS"))
        lines = {line.strip() for line in options.splitlines()}
        assert {"compression=kZSTD", "block_size=16384", "allow_fallocate=false"} <= lines
    assert {k: spark.conf.get(k, None) for k in two_streams.STATE_STORE} == before
