"""Physical plans that have to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from marketlane.functions.dates import in_days
from marketlane.operators.classify import first_seen, lookup_key, skew_ready
from marketlane.plans import facts, marts, pipeline, reports
from marketlane.plans.catalog import QUERIES, Work
from marketlane.streaming import two_streams


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_no_query_leaves_the_jvm_or_multiplies_rows(spark, small):
    # These write first and read the written tables.
    skip = ("src1_", "src5", "src6", "snk", "str1", "k6", "pl6", "run_")
    for name, fn in QUERIES.items():
        if name.startswith(skip):
            continue
        text = plan(fn(spark, small))
        assert not re.search(r"Python|ArrowEval|MapInPandas", text), name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_scan_reads_only_needed_columns(spark, small):
    text = formatted(reports.promo_impact(Work(spark, small).orders))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "o_custkey" not in schema and "o_orderdate" not in schema


def test_cohort_sketches_are_not_sent_once_a_month(spark, small):
    """The months' sketches go to all tasks; the cohorts' ones, repeated for their months, stay where they are."""
    w = Work(spark, small)
    groups = w.users_dim.select("user_id", F.trunc("registration_date", "month").alias("cohort"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reports.retention_from_sketches(marts.cohort_members(groups), marts.monthly_buyers(w.orders_fact)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"BroadcastHashJoin \[month#\d+\], \[month#\d+\], Inner, BuildRight", text)


def test_top_products_join_the_items_once(spark, small):
    assert "o_orderkey" not in formatted(QUERIES["srt2_top_products"](spark, small))


def test_batch_counts_of_orders_are_spread_whatever_they_weigh(spark, small, monkeypatch):
    true, made = two_streams.items_per_order, []
    monkeypatch.setattr(two_streams, "items_per_order", lambda rows: made.append(true(rows)) or made[-1])
    QUERIES["str1_two_stream_orders"](spark, small)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [rows.rdd.getNumPartitions() for rows in made] == [count] * 3


def test_status_filter_and_day_range_reach_the_scan(spark, tmp_path, small):
    path = str(tmp_path / "orders")
    Work(spark, small).orders.write.parquet(path)
    rows = spark.read.parquet(path).where("status = 'completed'").where(in_days("created_at", ["1997-06-15"]))
    text = formatted(rows)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "EqualTo(status,completed)" in pushed
    assert "GreaterThanOrEqual(created_at" in pushed and "LessThan(created_at" in pushed


@pytest.mark.parametrize("query, exchanges", [("q5_promo_impact", 2), ("q4_session_funnel", 4), ("m3_funnel_daily", 1)])
def test_number_of_shuffles(spark, small, query, exchanges):
    text = plan(QUERIES[query](spark, small))
    assert len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", text)) <= exchanges


def test_top_k_does_not_sort_everything(spark, small):
    assert "TakeOrderedAndProject" in plan(QUERIES["s2_market_basket"](spark, small))


def test_a_day_run_reads_only_the_deliveries_it_needs(spark, tmp_path):
    wh = pipeline.Warehouse(spark, str(tmp_path))
    days = [f"2025-01-{d:02d}" for d in range(1, 10)]
    rows = [(f"o{k}", "u", f"{ds} 10:00:00", ds) for k, ds in enumerate(days)]
    orders = spark.createDataFrame(rows, "order_id string, user_id string, created_at string, _source_date string")
    orders = orders.withColumn("created_at", F.col("created_at").cast("timestamp_ntz")).withColumn("_source_date", F.to_date("_source_date"))
    orders.write.partitionBy("_source_date").parquet(wh.path("core/orders"))
    orders.select("order_id", "_source_date").write.partitionBy("_source_date").parquet(wh.path("core/order_items"))
    cut = pipeline._delivered_with(wh.read("core/orders"), wh.read("core/order_items"), ["2025-01-08"])
    for frame, left in zip(cut, (1, 2)):
        assert re.search(r"PartitionFilters: \[[^\]]*_source_date", formatted(frame))
        assert frame.select("_source_date").distinct().count() == left


@pytest.fixture
def skewed(spark):
    """Thresholds small enough that test data count as skewed and nothing is broadcast."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_rows(spark, key):
    """A third of 30,000 rows share one key, another tenth has none."""
    n = F.col("id")
    value = F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise(F.concat(F.lit("k"), n))
    return spark.range(0, 30_000, 1, 8).select(
        value.alias(key), n.cast("string").alias("payload"), F.lit("2025-01-02").cast("date").alias("_source_date")
    )


def test_hot_key_of_a_lookup_is_split(skewed):
    rows = hot_rows(skewed, "id")
    arrivals = rows.where("id is not null").select("id", "_source_date")
    out = lookup_key(rows, "id", first_seen(arrivals, "id"), "id", "found", "_source_date")
    assert out.where("found").count() == rows.where("id is not null").count()
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    assert "SortMergeJoin(skew=true)" in plan(out)


def test_hot_user_and_hot_order_of_the_facts_are_split(skewed):
    spark = skewed
    orders = hot_rows(spark, "user_id").where("user_id is not null").select(
        F.col("payload").alias("order_id"), "user_id", F.lit("2025-01-02 10:00:00").cast("timestamp_ntz").alias("created_at"),
        *[F.lit("x").alias(c) for c in ("status", "payment_method")],
        *[F.lit(1).cast("decimal(12,2)").alias(c) for c in ("total_amount", "discount_amount")],
    )
    names = ["acquisition_channel", "city", "age_group"]
    deliveries = orders.select("user_id").distinct().select("user_id", *[F.lit("a").alias(c) for c in names])
    users = skew_ready(deliveries.groupBy("user_id").agg(*[F.max(c).alias(c) for c in names]))
    items = hot_rows(spark, "order_id").where("order_id is not null")
    fact = facts.orders_fact(orders, users, items.select("order_id"))
    assert len(fact.collect()) == orders.count()
    assert "SortMergeJoin(skew=true)" in plan(fact)

    items = items.withColumn("order_id", F.coalesce(F.nullif("order_id", F.lit("hot")), F.lit("3"))).select(
        F.col("payload").alias("order_item_id"), "order_id", F.lit("p").alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(1).cast("decimal(12,2)").alias("unit_price"),
    )
    products = spark.sql("select 'p' product_id, 1 category_id")
    categories = spark.sql("select 1 category_id, 'c' name")
    sold = facts.order_items_fact(items, orders, products, categories)
    assert len(sold.collect()) >= 10_000
    assert "SortMergeJoin(skew=true)" in plan(sold)
