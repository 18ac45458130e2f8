import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from marketlane.functions import columns as C, dates as D, sketches as S
from marketlane.operators import basket, cohorts, copies, percentiles, quality, upsert
from marketlane.operators.classify import first_reason, lookup_key
from marketlane.operators.funnel import window_funnel
from marketlane.plans import facts, marts, reports

STEPS = ["view", "cart", "purchase"]


def longest_chain(events, window):
    """Brute force over all step triples of one key."""
    at = {s: [t for t, kind in events if kind == s] for s in STEPS}
    if not at["view"]:
        return 0
    best = 1
    for a in at["view"]:
        for b in at["cart"]:
            if a <= b <= a + window:
                best = max(best, 2)
                if any(b <= c <= a + window for c in at["purchase"]):
                    return 3
    return best


def funnel_levels(spark, rows, window):
    df = spark.createDataFrame(rows, "k string, t bigint, kind string")
    start = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    df = df.select("k", "kind", (start + F.make_dt_interval(secs=F.col("t"))).alias("ts"))
    steps = [F.col("kind") == s for s in STEPS]
    return {r.k: r.level for r in window_funnel(df, ["k"], "ts", steps, window).collect()}


@pytest.mark.parametrize("window, horizon", [(20, 100), (60, 90), (1, 6), (86400, 400000)])
def test_window_funnel_equals_brute_force_with_ties(spark, window, horizon):
    rng = random.Random(window)
    step = max(1, horizon // 20)
    rows = [
        (f"k{k}", rng.randrange(0, horizon, step), rng.choice([*STEPS, "other"]))
        for k in range(400)
        for _ in range(rng.randrange(1, 9))
    ]
    by_key = {}
    for k, t, kind in rows:
        by_key.setdefault(k, []).append((t, kind))
    assert funnel_levels(spark, rows, window) == {k: longest_chain(v, window) for k, v in by_key.items()}


def test_window_funnel_bounds(spark):
    rows = [
        ("at_bound", 0, "view"), ("at_bound", 5, "cart"), ("at_bound", 10, "purchase"),
        ("past_bound", 0, "view"), ("past_bound", 5, "cart"), ("past_bound", 11, "purchase"),
        ("same_second", 3, "purchase"), ("same_second", 3, "view"), ("same_second", 3, "cart"),
        ("restart", 0, "view"), ("restart", 8, "view"), ("restart", 9, "cart"), ("restart", 18, "purchase"),
        ("older_start", 9, "view"), ("older_start", 10, "cart"), ("older_start", 11, "view"), ("older_start", 19, "purchase"),
        ("none", 0, "cart"),
    ]
    assert funnel_levels(spark, rows, 10) == {
        "at_bound": 3, "past_bound": 2, "same_second": 3, "restart": 3, "older_start": 3, "none": 0,
    }


def test_window_funnel_groups_stay_small_for_one_hot_key(spark):
    """300,000 events of one key in 100 seconds reach the windows as 100 rows."""
    n = 300_000
    df = spark.range(n).select(
        F.lit("hot").alias("k"),
        (F.lit("2025-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 100)).alias("ts"),
        F.element_at(F.array(*map(F.lit, STEPS)), (F.col("id") % 3 + 1).cast("int")).alias("kind"),
    )
    steps = [F.col("kind") == s for s in STEPS]
    assert window_funnel(df, ["k"], "ts", steps, 10).collect()[0].level == 3


def test_mark_copies_equals_plain_ranking(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", f"k{rng.randrange(50)}"]), rng.randrange(4), rng.randrange(6), rng.random() < 0.8) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, run int, t int, ok boolean").repartition(7)
    got = copies.mark_copies(df, ["k"], ["run"], ["t"], F.col("ok"), salts=4)
    found = sorted((r.k, r.run, r.t, r.ok, r.copy_state) for r in got.collect() if r.ok)
    want, groups = [], {}
    for k, run, t, ok in rows:
        if ok:
            groups.setdefault(k, {}).setdefault(run, []).append(t)
    for k, runs in groups.items():
        for i, run in enumerate(sorted(runs)):
            for j, t in enumerate(sorted(runs[run])):
                state = copies.SAME_RUN if j else copies.LATER_RUN if i else copies.FIRST
                want.append((k, run, t, True, state))
    assert found == sorted(want)
    assert got.where("not ok").where("copy_state is not null").count() == 0
    assert got.count() == len(rows)


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int").repartition(2)
    out = copies.first_per_key(df, ["k"], ["v"])
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 5)]


def test_lookup_key_spreads_missing_keys(spark):
    rows = spark.createDataFrame([("1", "x"), (None, "y"), ("9", "z")], "id string, v string")
    rows = rows.withColumn("day", F.lit("2025-01-02").cast("date"))
    known = spark.createDataFrame([("1", "2025-01-01"), ("9", "2025-01-03")], "id string, d string")
    known = known.select("id", F.col("d").cast("date").alias("first_ds"))
    seen = {r.v: (r.id, r.found) for r in lookup_key(rows, "id", known, "id", "found", "day").collect()}
    assert seen == {"x": ("1", True), "y": (None, False), "z": ("9", False)}
    ever = {r.v: r.found for r in lookup_key(rows, "id", known, "id", "found", None).collect()}
    assert ever == {"x": True, "y": False, "z": True}


def test_first_reason_keeps_priority(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0)], "a int, b int")
    reason = first_reason([("a", F.col("a") == 1), ("b", F.col("b") == 1)])
    assert [r[0] for r in df.select(reason).collect()] == ["a", "b", None]


def test_baskets_are_spread_whatever_they_weigh(spark):
    rows = spark.range(400).select((F.col("id") % 90).alias("o"), (F.col("id") % 7).cast("string").alias("c"))
    lines = basket.lines_per_category(rows, "o", "c")
    assert lines.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert lines.agg(F.sum("n")).first()[0] == 400


def test_basket_forms_agree_with_brute_force(spark):
    rng = random.Random(11)
    rows = [(f"o{rng.randrange(60)}", rng.choice("ABCDEF")) for _ in range(600)] + [("hot", rng.choice("ABC")) for _ in range(400)]
    want, orders = {}, {}
    for o, c in rows:
        orders.setdefault(o, []).append(c)
    for cats in orders.values():
        for x, y in combinations(cats, 2):
            if x != y:
                want[tuple(sorted((x, y)))] = want.get(tuple(sorted((x, y))), 0) + 1
    df = spark.createDataFrame(rows, "o string, c string")
    for form in (basket.category_pairs, basket.category_pairs_by_join):
        assert {(r.cat_a, r.cat_b): r.together for r in form(df, "o", "c").collect()} == want


def test_upsert_takes_null_from_latest(spark):
    rows = [("1", "a", 1.0, "d1"), ("1", "b", None, "d2"), ("2", "c", 3.0, "d1")]
    df = spark.createDataFrame(rows, "k string, name string, rating double, _source_date string")
    got = sorted(map(tuple, upsert.upsert_by_policy(df, "k", ["rating"]).collect()))
    assert got == [("1", "a", None, "d1"), ("2", "c", 3.0, "d1")]


@pytest.mark.parametrize("scale, top", [(0, 30), (0, 10**11), (2, 5_000)])
def test_percentiles_are_exact(spark, scale, top):
    rng = random.Random(top)
    values = [rng.randrange(top) for _ in range(501)] + [top] * 100
    df = spark.createDataFrame([(v,) for v in values], "c bigint").select((F.col("c") / F.lit(10**scale)).cast(f"decimal(14,{scale})").alias("v"))
    points = {"lowest": 0.0, "median": 0.5, "p73": 0.73, "highest": 1.0}
    got = percentiles.percentiles(df, "v", points, scale=scale).first()
    want = df.agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in points.items()]).first()
    assert got.max_value == top / 10**scale
    for name in points:
        assert got[name] == pytest.approx(want[name], rel=1e-12)


def test_sketch_estimates_stay_within_error(spark):
    df = spark.range(200_000).select((F.col("id") % 50_000).cast("string").alias("u"), (F.col("id") % 8).alias("part"))
    row = reports.distinct_three_ways(df, "u").first()
    assert row.exact == 50_000
    assert abs(row.combined - 50_000) < 4 * 0.01 * 50_000
    assert abs(row.hll12 - 50_000) < 4 * S.HLL_ERROR * 50_000
    parts = df.groupBy("part").agg(S.uniq_state("u").alias("s"))
    assert abs(parts.agg(S.uniq_merge("s").alias("n")).first().n - 50_000) < 4 * S.HLL_ERROR * 50_000


def test_retention_counts_only_from_the_cohort_on(spark):
    groups = spark.sql("select 'u' user_id, date '2025-03-01' cohort")
    activity = spark.sql("select 'u' user_id, explode(array(date '2025-02-01', date '2025-03-01', date '2026-01-01')) active_month")
    long = cohorts.retention(groups, activity, "user_id")
    assert sorted((r.month_offset, r.users) for r in long.collect()) == [(0, 1), (10, 1)]
    assert cohorts.retention_matrix(long, range(11)).first().asDict()["m10"] == 1


def test_text_casts(spark):
    df = spark.createDataFrame([("1.0", "", "12.345"), ("2.5", "7", "")], "a string, b string, c string")
    got = df.select(C.int_from_text("a"), C.int_from_text("b"), C.decimal_or_zero("c").cast("string")).collect()
    assert [tuple(r) for r in got] == [(1, None, "12.35"), (3, 7, "0.00")]


def test_uuid_forms(spark):
    df = spark.createDataFrame([("{0A0B0C0D-0000-4000-8000-00000000000F}",), (None,)], "u string")
    assert [r[0] for r in df.select(C.canonical_uuid("u")).collect()] == ["0a0b0c0d-0000-4000-8000-00000000000f", None]
    bad = spark.createDataFrame([("xyz",)], "u string").select(C.canonical_uuid("u"))
    with pytest.raises(Exception, match="not a uuid"):
        bad.collect()


def test_retention_of_events_uses_calendar_months(spark):
    df = spark.sql("select explode(array(timestamp_ntz '2022-12-31 23:59:59', timestamp_ntz '2023-01-31 00:00:00', timestamp_ntz '2023-01-31 00:00:01')) t")
    kept = [str(r.t) for r in df.where(D.not_expired("t", "2025-01-31", 24)).collect()]
    assert kept == ["2023-01-31 00:00:01"]


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz '2025-03-09 02:30:15.75' t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(D.epoch_seconds("t").alias("s"), D.whole_seconds("t").cast("string").alias("w")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.s, row.w) == (1741487415, "2025-03-09 02:30:15")


def test_constraint_report_finds_each_kind(spark):
    orders = spark.createDataFrame([("o1", "u1", "-1"), ("o1", None, "2")], "order_id string, user_id string, t string").select(
        "order_id", "user_id", F.lit(None).cast("timestamp_ntz").alias("created_at"), F.col("t").cast("decimal(12,2)").alias("total_amount")
    )
    users = spark.createDataFrame([("u2", "e", "2025-01-01")], "user_id string, email string, registration_date string")
    report = quality.constraint_report({"orders": orders, "users": users})
    bad = {(r.source_table, r.rule, r.column_name): r.violations for r in report.where("violations > 0").collect()}
    assert bad == {
        ("orders", "not_null", "user_id"): 1, ("orders", "not_null", "created_at"): 2,
        ("orders", "check", "total_amount"): 1, ("orders", "unique", "order_id"): 1,
        ("orders", "foreign_key", "user_id"): 1,
    }
    with pytest.raises(quality.QualityError, match="orders.order_id unique: 1"):
        quality.require_zero(report)


def test_parent_names_fill_only_on_request(spark):
    categories = spark.createDataFrame([(1, "Root", None), (2, "Leaf", 1)], "category_id int, name string, parent_id int")
    products = spark.createDataFrame(
        [("p", "n", 2), ("q", "m", None)], "product_id string, name string, category_id int"
    ).withColumns({c: F.lit(None).cast("decimal(12,2)") for c in ("price", "cost_price", "rating")}).withColumn("is_available", F.lit(True))
    pick = lambda rows: {r.product_id: (r.category_name, r.parent_category) for r in rows.collect()}
    assert pick(facts.products_dim(products, categories)) == {"p": ("Leaf", ""), "q": ("Без категории", "")}
    assert pick(facts.products_dim(products, categories, fill_parent=True)) == {"p": ("Leaf", "Root"), "q": ("Без категории", "")}


def test_zero_sales_day_is_found(spark):
    merged = spark.sql("select explode(array(date '2025-01-01', date '2025-01-02', date '2025-01-04')) day")
    assert [str(r.day) for r in reports.missing_sales_days(merged).collect()] == ["2025-01-03"]


def test_collapsed_states_read_like_single_ones(spark, small):
    from marketlane.plans.catalog import Work

    fact = Work(spark, small).orders_fact
    parts = marts.daily_gmv(fact, "payment_method").drop("payment_method")
    once = marts.daily_gmv_merge(marts.daily_gmv(fact)).orderBy("day").collect()
    assert marts.daily_gmv_merge(marts.daily_gmv_collapse(parts)).orderBy("day").collect() == once
    assert marts.daily_gmv_merge(parts).orderBy("day").collect() == once
