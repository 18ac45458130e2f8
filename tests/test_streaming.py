from pyspark.sql import functions as F

from marketlane.plans import facts, marts
from marketlane.schemas import FACT_TABLES
from marketlane.sources import landing, storage
from marketlane.streaming import incremental
from tests.shop_files import event, write_day

LAYOUT = FACT_TABLES["events_fact"]


def make_batch(spark, folder, n, rows):
    df = spark.createDataFrame(rows, "u string, s string, p string, k string, t string")
    df.select(
        F.col("u").alias("user_id"), F.col("s").alias("session_id"), F.col("p").alias("product_id"),
        F.col("k").alias("event_type"), F.col("t").cast("timestamp_ntz").alias("created_at"),
    ).coalesce(1).write.mode("append").parquet(f"{folder}/b{n}")


def stream(spark, folder):
    return spark.readStream.schema(LAYOUT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/b*")


BATCHES = [
    [("u1", "s1", "p", "view", "2025-01-05 10:00:00"), ("u1", "s1", "p", "cart", "2025-01-05 11:00:00")],
    [("u2", "s2", "p", "view", "2025-01-01 10:00:00")],  # four days late, still counted
    [("u2", "s2", "p", "purchase", "2025-01-05 23:59:59"), ("u1", "s1", "p", "view", "2025-01-05 10:00:00")],
]
TOTALS = [("2025-01-01", 1, 0, 0), ("2025-01-05", 2, 1, 1)]


def totals(rows):
    return sorted((str(r.day), r.views, r.carts, r.purchases) for r in rows.collect())


def test_running_totals_survive_restart_and_keep_late_rows(spark, tmp_path):
    src, mart, state = (str(tmp_path / n) for n in ("src", "mart", "state"))
    for n, rows in enumerate(BATCHES):
        make_batch(spark, src, n, rows)
        incremental.run_funnel_stream(stream(spark, src), mart, state)
    assert totals(spark.read.parquet(mart)) == TOTALS


def test_ingest_by_batch_equals_one_batch(spark, tmp_path):
    src, root, state = (str(tmp_path / n) for n in ("src", "root", "state"))
    for n, rows in enumerate(BATCHES):
        make_batch(spark, src, n, rows)
    incremental.run_fact_ingest(stream(spark, src), "events_fact", root, state)
    mart, fact = f"{root}/funnel_daily", f"{root}/events_fact"
    assert spark.read.parquet(mart).count() == 3
    assert totals(marts.funnel_merge(spark.read.parquet(mart))) == TOTALS
    assert totals(marts.funnel_daily(spark.read.parquet(fact))) == TOTALS
    incremental.run_fact_ingest(stream(spark, src), "events_fact", root, state)
    assert spark.read.parquet(fact).count() == 5
    for _ in range(2):  # the second finds nothing to do
        incremental.compact(spark, "events_fact", root)
        assert len([c for c in storage.children(spark, mart) if c.startswith("batch=")]) == 1
        assert spark.read.parquet(mart).count() == 2 and spark.read.parquet(fact).count() == 5
        assert totals(marts.funnel_merge(spark.read.parquet(mart))) == TOTALS
        assert totals(marts.funnel_daily(spark.read.parquet(fact))) == TOTALS
    make_batch(spark, src, 9, BATCHES[1])
    incremental.run_fact_ingest(stream(spark, src), "events_fact", root, state)
    assert spark.read.parquet(fact).count() == 6 and spark.read.parquet(mart).count() == 3


def test_repeated_delivery_is_dropped_on_request(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    for n, rows in enumerate(BATCHES):
        make_batch(spark, src, n, rows)
    clean = incremental.dedup_stream(spark.readStream.schema(LAYOUT).parquet(f"{src}/b*"), "30 days")
    clean.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_landing_events_can_be_streamed(spark, tmp_path):
    raw, root, state = (str(tmp_path / n) for n in ("raw", "root", "state"))
    for n, ds in enumerate(["2025-01-01", "2025-01-02"]):
        write_day(tmp_path / "raw", ds, events=[event(n, n, k, f"{ds} 10:00:00.5") for k in ("view", "cart")])
        rows = facts.events_fact(landing.stream_typed_events(spark, raw, 1))
        incremental.run_fact_ingest(rows, "events_fact", root, state)
    stored = marts.funnel_merge(spark.read.parquet(f"{root}/funnel_daily"))
    assert totals(stored) == [("2025-01-01", 1, 1, 0), ("2025-01-02", 1, 1, 0)]
