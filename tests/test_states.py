"""States that merge: numbers and bitmaps, theta and KLL sketches, heavy hitters."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlane.functions import states
from marketlane.operators import heavy_hitters, numbering
from marketlane.operators.quality import union_all
from marketlane.plans import marts, reports


# ---- numbers -----------------------------------------------------------------------


@pytest.mark.parametrize("groups", [1, 5, 400])
def test_numbers_have_no_gaps_and_stay(spark, groups):
    keys = spark.createDataFrame([(f"u{k % 700}",) for k in range(1500)] + [(None,)], "u string")
    first = numbering.numbered(keys, "u", groups=groups)
    assert sorted(r["number"] for r in first.collect()) == list(range(700))
    assert sorted(first.collect()) == sorted(numbering.numbered(keys.repartition(3), "u", groups=groups).collect())
    more = spark.createDataFrame([(f"u{k}",) for k in range(650, 900)], "u string")
    known = spark.createDataFrame(first.collect(), first.schema)
    second = numbering.numbered(more, "u", known, groups)
    assert sorted(r["number"] for r in second.collect()) == list(range(700, 900))
    assert not {r["u"] for r in second.collect()} & {r["u"] for r in first.collect()}


def test_numbering_nothing(spark):
    none = spark.createDataFrame([], "u string")
    assert numbering.numbered(none, "u").count() == 0
    known = numbering.numbered(spark.createDataFrame([("a",)], "u string"), "u")
    assert numbering.numbered(none, "u", known).count() == 0
    again = numbering.numbered(spark.createDataFrame([("b",), ("a",)], "u string"), "u", numbering.numbered(none, "u"))
    assert sorted(r["number"] for r in again.collect()) == [0, 1]


# ---- exact sets ----------------------------------------------------------------------


def orders(spark, n=4000, users=90_000, seed=1):
    rng = random.Random(seed)
    rows = [(f"o{k}", rng.randrange(users), f"2024-01-{rng.randrange(1, 29):02d} 10:00:00", rng.choice(["completed", "returned"]), rng.randrange(1, 10**6)) for k in range(n)]
    df = spark.createDataFrame(rows, "order_id string, user_id long, created_at string, status string, cents long")
    return df.withColumns({"created_at": F.col("created_at").cast("timestamp_ntz"), "user_id": F.col("user_id").cast("string"), "total_amount": (F.col("cents") / 100).cast("decimal(12,2)")})


def cuts(df, n=3):
    part = F.pmod(F.xxhash64(*df.columns), F.lit(n))
    return [df.where(part == k) for k in range(n)]


def test_buyers_of_any_span_from_the_mart_alone(spark):
    df = orders(spark)
    # numbers far apart: several buckets
    numbers = df.select("user_id", F.col("user_id").cast("bigint").alias("number")).distinct()
    parts = cuts(df)
    mart = union_all([marts.daily_buyers(p, numbers) for p in (*parts, parts[0])])
    assert mart.select("bucket").distinct().count() == 3
    for first, last in (("2024-01-01", "2024-01-31"), ("2024-01-05", "2024-01-05"), ("2024-01-10", "2024-01-20")):
        paid = df.where("status = 'completed'").where(F.to_date("created_at").between(first, last))
        assert marts.buyers_of_span(mart, first, last).first()["buyers"] == paid.select("user_id").distinct().count()
    assert marts.buyers_of_span(mart, "2030-01-01", "2030-01-02").first()["buyers"] is None
    merged = states.bitmap_merge(mart, "day")
    assert sorted(states.bitmap_distinct(merged, "day").collect()) == sorted(states.bitmap_distinct(mart, "day").collect())


# ---- theta -----------------------------------------------------------------------------


def test_overlaps_within_the_bound(spark):
    small = 8  # 256 entries, so that sets of thousands are sampled
    inside = 0
    for shift in (100, 1500, 2900, 4000):
        a, b = spark.range(0, 3000), spark.range(shift, shift + 5000)
        sketches = a.agg(states.theta_state("id", small).alias("a")).crossJoin(b.agg(states.theta_state("id", small).alias("b")))
        estimate = sketches.select(states.theta_overlap("a", "b").alias("n")).first()["n"]
        overlap = max(0, 3000 - shift)
        bound = spark.range(1).select(states.theta_bound(F.lit(overlap), F.lit(5000), small)).first()[0]
        assert abs(estimate - overlap) <= bound
        inside += estimate != overlap
    assert inside  # the sketches were really estimates


def test_small_sets_are_exact_and_merge(spark):
    df = orders(spark, users=500)
    cohorts = df.select("user_id").distinct().withColumn("cohort", F.lit("2023-12-01").cast("date"))
    sketches = union_all([marts.monthly_buyers(p) for p in cuts(df)])
    got = reports.retention_from_sketches(marts.cohort_members(cohorts), sketches).collect()
    paid = df.where("status = 'completed'").select("user_id").distinct().count()
    assert {(r["month_offset"], r["users"]) for r in got} == {(1, paid)}
    none = reports.retention_from_sketches(marts.cohort_members(cohorts), marts.monthly_buyers(df.limit(0)))
    assert none.count() == 0


# ---- KLL -------------------------------------------------------------------------------


@pytest.mark.parametrize("k", [50, 400])
def test_merged_quantiles_within_rank_error(spark, k):
    df = orders(spark, n=20_000, seed=3)
    parts = union_all([marts.daily_order_values(p, k=k) for p in cuts(df, 5)])
    points = {"p01": 0.01, "median": 0.5, "p99": 0.99}
    found = marts.order_value_quantiles(parts, points, k=k).first()
    values = sorted(float(r["total_amount"]) for r in df.where("status = 'completed'").select("total_amount").collect())
    assert found["orders"] == len(values)
    for name, point in points.items():
        rank = sum(v <= found[name] for v in values) / len(values)
        assert abs(rank - point) <= 2 * states.kll_rank_error(k)


# ---- heavy hitters ---------------------------------------------------------------------


def sales(spark, seed=5, keys=3000, n=20_000, skew=1.2):
    rng = random.Random(seed)
    rows = [(f"p{min(keys, int(rng.paretovariate(skew)))}", rng.randrange(0, 500), f"d{rng.randrange(4)}") for _ in range(n)]
    rows += [(None, 5, "d0"), ("p1", None, "d1"), ("p2", 7, None)]
    return spark.createDataFrame(rows, "k string, w long, d string").repartition(7), rows


def exact(rows):
    sums = Counter()
    for k, w, _ in rows:
        if k is not None and w is not None:
            sums[k] += w
    return sums


@pytest.mark.parametrize("counters, pending", [(5, 300), (40, 1000), (10_000, 1 << 18)])
def test_bounds_hold_after_any_merge(spark, monkeypatch, counters, pending):
    monkeypatch.setattr(heavy_hitters, "PENDING", pending)
    df, rows = sales(spark)
    sums = exact(rows)
    parts = heavy_hitters.summaries(df, "k", "w", ["d"], counters)
    parts = spark.createDataFrame(parts.collect(), parts.schema)
    per_day = heavy_hitters.merge(parts, "k", ["d"], counters)
    assert per_day.where("k is not null").groupBy("d").count().agg(F.max("count")).first()[0] <= counters
    for level in (parts, per_day, heavy_hitters.merge(per_day.drop("d"), "k", (), counters)):
        low = {r["k"]: r["n"] for r in level.where("k is not null").groupBy("k").agg(F.sum("weight").alias("n")).collect()}
        off = level.agg(F.coalesce(F.sum("offset"), F.lit(0))).first()[0]
        assert all(low.get(k, 0) <= n <= low.get(k, 0) + off for k, n in sums.items())
        assert off <= sum(sums.values())


@pytest.mark.parametrize("counters", [3, 60, 5000])
def test_top_sums_are_exact(spark, counters):
    df, rows = sales(spark)
    expected = sorted(exact(rows).items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [tuple(r) for r in heavy_hitters.top_sums(df, "k", "w", 10, counters=counters).collect()] == expected


def test_flat_sums_and_ties_fall_back_to_all_keys(spark):
    rows = [(f"p{k:04d}", 1, "d") for k in range(2000)]
    df = spark.createDataFrame(rows, "k string, w long, d string")
    parts = heavy_hitters.summaries(df, "k", "w", counters=10)
    assert heavy_hitters.survivors(parts, "k", 10)[1] is False
    assert [r["k"] for r in heavy_hitters.top_sums(df, "k", "w", 10, counters=10).collect()] == [f"p{k:04d}" for k in range(10)]


def test_the_recount_shuffles_the_survivors_only(spark):
    df, _ = sales(spark)
    parts = heavy_hitters.summaries(df, "k", "w", counters=300)
    wanted, sure = heavy_hitters.survivors(spark.createDataFrame(parts.collect(), parts.schema), "k", 5)
    assert sure and wanted.count() < 60
    text = heavy_hitters.top_sums(df, "k", "w", 5, counters=300)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_nothing_and_negative_weights(spark):
    none = spark.createDataFrame([], "k string, w long, d string")
    assert heavy_hitters.top_sums(none, "k", "w", 5).count() == 0
    bad = spark.createDataFrame([("a", -1, "d")], "k string, w long, d string")
    with pytest.raises(Exception, match="negative"):
        heavy_hitters.summaries(bad, "k", "w").collect()


def test_top_products_from_stored_daily_summaries(spark):
    rng = random.Random(9)
    rows = [(f"p{min(400, int(rng.paretovariate(0.9)))}", f"2024-01-{rng.randrange(1, 10):02d} 01:00:00", rng.randrange(1, 10_000)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "product_id string, at string, cents long").select(
        "product_id", F.col("at").cast("timestamp_ntz").alias("order_created_at"), (F.col("cents") / 100).cast("decimal(18,2)").alias("line_revenue")
    )
    parts = marts.product_revenue_summaries(df, counters=50)
    stored = spark.createDataFrame(parts.collect(), parts.schema)
    sums = Counter()
    for k, _, c in rows:
        sums[k] += c
    expected = sorted(sums.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [(r["product_id"], int(r["revenue"] * 100)) for r in reports.top_products(df, 10, stored).collect()] == expected


def test_bitmaps_are_spread_whatever_they_weigh(spark):
    """Sparse bitmaps shrink to little when sent; tasks must not be merged by that, nor bitmaps summed before."""
    rows = spark.range(300).select((F.col("id") % 30).alias("day"), (F.col("id") * 100_000).alias("number"))
    mart = states.bitmap_states(rows, "number", "day")
    merged = states.bitmap_merge(mart, "day")
    assert mart.rdd.getNumPartitions() == merged.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert merged.count() == 300
