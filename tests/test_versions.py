"""Versions valid at a time against a plain search per row."""

import random

import pytest
from pyspark.sql import functions as F

from marketlane.operators import versions as V

START = "2024-01-01 00:00:00"


def timed(spark, rows, ddl, column):
    df = spark.createDataFrame(rows, ddl)
    at = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col(column))
    return df.withColumn(column, at)


def plain(rows, versions):
    out = []
    for n, key, at in rows:
        best = max(((t, (a is not None, a), b, a) for k, t, a, b in versions if None not in (key, at, k, t) and k == key and t <= at), default=None)
        out.append((n, key, best and best[3], best and best[2]))
    return sorted(out, key=repr)


def found(spark, rows, versions, bucket):
    left = timed(spark, rows, "n long, k string, at long", "at")
    right = timed(spark, versions, "k string, since long, a string, b long", "since")
    got = V.valid_at(left, right, "k", "at", "since", ["a", "b"], "v_", bucket)
    return sorted(((r["n"], r["k"], r["v_a"], r["v_b"]) for r in got.collect()), key=repr)


@pytest.mark.parametrize("bucket", [1, 7, 50, 10**6])
def test_equals_a_search_per_row(spark, bucket):
    rng = random.Random(bucket)
    keys = [f"k{i}" for i in range(12)] + ["hot"] * 12 + [None]
    rows = [(n, rng.choice(keys), rng.choice([None, *range(0, 400)])) for n in range(600)]
    rows += rows[:20]  # repeated rows stay
    versions = [(rng.choice(keys), rng.choice([None, *range(0, 400, 3)]), rng.choice([None, "x", "y"]), n) for n in range(150)]
    seen, unique = set(), []
    for v in versions:  # equal times of a key are tested apart
        if v[:2] not in seen:
            unique.append(v)
            seen.add(v[:2])
    assert found(spark, rows, unique, bucket) == plain(rows, unique)


def test_bounds_and_ties(spark):
    rows = [(1, "k", 9), (2, "k", 10), (3, "k", 11), (4, "other", 50), (5, None, 10), (6, "k", None)]
    versions = [("k", 10, "a", 1), ("k", 10, "b", 0), (None, 0, "z", 9), ("k", None, "z", 9)]
    expected = [(1, "k", None, None), (2, "k", "b", 0), (3, "k", "b", 0), (4, "other", None, None), (5, None, None, None), (6, "k", None, None)]
    for bucket in (1, 5, 1000):
        assert found(spark, rows, versions, bucket) == expected


def test_empty_sides(spark):
    assert found(spark, [], [("k", 1, "a", 1)], 5) == []
    assert found(spark, [(1, "k", 5)], [], 5) == [(1, "k", None, None)]


def test_a_version_with_missing_values_still_holds(spark):
    """A city that became unknown is not the city of before."""
    assert found(spark, [(1, "k", 30)], [("k", 0, "a", 1), ("k", 20, None, None)], 10) == [(1, "k", None, None)]


def test_change_points(spark):
    rows = [("k", 0, "a", 1), ("k", 5, "a", 1), ("k", 9, "b", 1), ("k", 12, None, 1), ("k", 15, None, 1), ("k", 20, "a", 1)]
    rows += [("m", 3, None, None), ("m", 3, "z", None), (None, 1, "q", 1), ("n", None, "q", 1)]
    df = V.change_points(timed(spark, rows, "k string, since long, a string, b long", "since"), "k", "since", ["a", "b"])
    seconds = lambda c: F.unix_timestamp(F.col(c).cast("string")) - F.unix_timestamp(F.lit(START))
    got = {tuple(r) for r in df.select("k", seconds("since"), seconds("valid_to"), "a").collect()}
    assert got == {("k", 0, 9, "a"), ("k", 9, 12, "b"), ("k", 12, 20, None), ("k", 20, None, "a"), ("m", 3, None, "z")}


def test_names_may_clash(spark):
    left = timed(spark, [(1, "k", 5, "x")], "n long, k string, at long, `a.b` string", "at")
    right = timed(spark, [("k", 1, "a", 1)], "k string, since long, a string, b long", "since")
    row = V.valid_at(left, right, "k", "at", "since", ["a"], "v_").first()
    assert row["a.b"] == "x" and row["v_a"] == "a"


def test_plan_has_no_pairs_of_rows_and_versions(spark):
    left = timed(spark, [(1, "k", 5)], "n long, k string, at long", "at")
    right = timed(spark, [("k", 1, "a", 1)], "k string, since long, a string, b long", "since")
    plan = V.valid_at(left, right, "k", "at", "since", ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
    assert "hashpartitioning(_key#" in plan and "_bucket" in plan
