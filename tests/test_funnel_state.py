"""Funnel levels from merged states against the one-pass operator."""

import random

import pytest
from pyspark.sql import functions as F

from marketlane.operators import funnel_state as S
from marketlane.operators.funnel import window_funnel
from marketlane.operators.quality import union_all

STEPS = ["a", "b", "c", "d"]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "k string, t bigint, kind string, part int")
    start = F.lit("2024-12-31 23:50:00").cast("timestamp_ntz")
    return df.withColumn("ts", start + F.make_dt_interval(secs=F.col("t")))


def steps(n):
    return [F.col("kind") == s for s in STEPS[:n]]


def rows(seed, keys, most, horizon, grain, n):
    rng = random.Random(seed)
    out = []
    for k in range(keys):
        for _ in range(rng.randrange(1, most)):
            out.append((f"k{k}", rng.randrange(0, horizon, grain), rng.choice([*STEPS[:n], "other"]), rng.randrange(4)))
    return out


def as_map(df):
    return {r["k"]: r["level"] for r in df.select("k", "level").collect()}


@pytest.mark.parametrize(
    "n, window, horizon, grain, period",
    [(3, 20, 100, 5, 1), (3, 3600, 90_000, 1, 1440), (4, 300, 4000, 60, 2), (2, 1, 10, 1, 1), (3, 90_000, 400_000, 977, 100), (1, 5, 50, 1, 1)],
)
def test_any_cut_equals_the_one_pass_operator(spark, n, window, horizon, grain, period):
    df = frame(spark, rows(window, 150, 14, horizon, grain, n))
    expected = as_map(window_funnel(df, ["k"], "ts", steps(n), window))
    for cut in (F.col("part"), F.floor(F.col("t") / (horizon / 4)).cast("int"), F.lit(0)):
        parts = [S.cells(df.where(cut == p), ["k"], "ts", steps(n)) for p in range(5)]
        merged = union_all([*parts, parts[1]])  # one part comes twice
        assert as_map(S.levels(merged, ["k"], n, window, period_cells=period)) == expected


def test_combining_is_associative(spark):
    df = frame(spark, rows(7, 80, 20, 1500, 7, 3))
    days = S.summaries(S.cells(df, ["k"], "ts", steps(3)), ["k"], 3, 200, period_cells=3)
    days = spark.createDataFrame(days.collect(), days.schema)
    cut = days.agg(F.expr("percentile_approx(period, 0.5)")).first()[0]
    whole = S.combine(days, ["k"], 3, 200)
    left = S.combine(days.where(F.col("period") <= cut), ["k"], 3, 200)
    right = S.combine(days.where(F.col("period") > cut), ["k"], 3, 200)
    assert sorted(S.combine(left.unionByName(right), ["k"], 3, 200).drop("period").collect()) == sorted(whole.drop("period").collect())


def test_sizes_do_not_follow_the_events(spark):
    df = spark.range(200_000).select(
        F.lit("hot").alias("k"), (F.col("id") % 120).alias("t"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"), F.lit(0).alias("part")
    )
    df = frame(spark, [("hot", 0, "other", 0)]).limit(0).unionByName(
        df.withColumn("ts", F.lit("2024-12-31 23:50:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("t")))
        .withColumns({"part": F.col("part").cast("int")})
    )
    cells = S.cells(df, ["k"], "ts", steps(3))
    assert cells.count() == 2
    assert as_map(S.levels(cells, ["k"], 3, 60)) == {"hot": 2}


def test_missing_values(spark):
    df = frame(spark, [("k", 0, "a", 0), ("k", 5, None, 0), (None, 0, "a", 0), ("only", 1, "b", 0)])
    assert as_map(S.levels(S.cells(df, ["k"], "ts", steps(2)), ["k"], 2, 10)) == {"k": 1, None: 1, "only": 0}
    assert S.levels(S.cells(df.limit(0), ["k"], "ts", steps(2)), ["k"], 2, 10).count() == 0
