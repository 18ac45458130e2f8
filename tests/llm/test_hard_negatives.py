import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlane.llm import hard_negatives


def frame(spark, rows):
    """Columns after ``label`` clash with names that the operator uses inside."""
    return spark.createDataFrame(
        [(i, l, v, 1, "k", 2) for i, l, v in rows], "vec_id long, label int, embedding array<float>, row int, `a.b` string, cell int"
    )


def plain(rows, step, positives=5, negatives=3):
    ok = set()
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in ok:
        if i % step:
            continue
        others = [(-dot(v, w), j, m) for j, m, w in ok if j != i]
        near = sorted(o[:2] for o in others if o[2] == label)[:positives]
        far = sorted(o[:2] for o in others if o[2] != label)
        for p, j in near:
            fits = [(s, k) for s, k in far if 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fits)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def random_rows(seed, count, width=20, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((labels, width))
    rows = []
    for k in range(count):
        label = int(rng.integers(labels))
        v = 0.4 * middle[label] + rng.standard_normal(width)
        rows.append((k, label, (v / np.linalg.norm(v)).astype(np.float32).tolist()))
    return rows


@pytest.mark.parametrize("cell_bytes,least,tile", [(8 << 20, 2048, 512), (2000, 10, 3)])
def test_equals_brute_force(spark, monkeypatch, cell_bytes, least, tile):
    monkeypatch.setattr(hard_negatives, "CELL_BYTES", cell_bytes)
    monkeypatch.setattr(hard_negatives, "LEAST_CELL", least)
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    rows = random_rows(1, 300)
    assert got(hard_negatives.mine(frame(spark, rows), 20)) == plain(rows, 20)


def test_copies_and_ties(spark):
    rows = random_rows(2, 200)
    rows += [(k, 1, rows[20][2]) for k in range(200, 320)]  # one vector a hundred times
    rows += [(k, k % 3, rows[40][2]) for k in range(320, 380)]  # and one under several labels
    rows += rows[:30]
    assert got(hard_negatives.mine(frame(spark, rows), 20)) == plain(rows, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.7, 0.1]), (3, 2, [0.0, 0.0]), (20, 1, [0.0, 0.0]), (40, 2, [-1.0, 0.2])]
    rows += [(4, None, [1.0, 1.0]), (5, 1, None), (6, 1, [1.0, None]), (7, 2, [nan, 0.0]), (8, 2, [inf, 0.0]), (None, 2, [0.6, 0.0])]
    rows += [(20, 3, [1.0, 0.1]), (9, 3, [0.9, 0.0]), (60, 9, [0.5, 0.5])]
    assert got(hard_negatives.mine(frame(spark, rows), 20)) == plain(rows, 20)
    # another width takes no part
    assert got(hard_negatives.mine(frame(spark, rows + [(10, 1, [1.0, 1.0, 1.0])]), 20)) == plain(rows, 20)
    empty = hard_negatives.mine(frame(spark, []), 20)
    assert empty.count() == 0 and [f.name for f in empty.schema] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hard_negatives.mine(frame(spark, [(1, 1, [1.0])]), 20).count() == 0  # no anchors
    assert hard_negatives.mine(frame(spark, [(0, 1, [])]), 20).count() == 0


def test_large_and_sparse_components(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(150):
        v = np.zeros(30)
        own = rng.choice(30, 4, replace=False)
        v[own] = rng.standard_normal(4) * 10.0 ** rng.integers(0, 5)
        rows.append((k, int(rng.integers(3)), v.astype(np.float32).tolist()))
    assert got(hard_negatives.mine(frame(spark, rows), 10)) == plain(rows, 10)


def test_relabelled(spark):
    df = spark.createDataFrame([(7, 9), (8, 9), (14, 0), (0, 3)], "vec_id long, label int")
    assert [r[0] for r in df.select(hard_negatives.relabelled()).collect()] == [0, 9, 1, 4]


def test_index_omits_covered_dimensions():
    """Pairs above the threshold are found although rows are indexed in part; a spy counts the products."""
    rng = np.random.default_rng(6)
    energy = 0.6 ** np.arange(64)
    x = np.floor(256 * rng.standard_normal((400, 64)) * energy).astype(np.int32)
    q = x[:20]
    t = np.full(20, int(0.5 * np.linalg.norm(x, axis=1).max() ** 2))
    wins = hard_negatives.Windows(np.arange(20), np.zeros(20, dtype=int), np.zeros(20, dtype=int), np.full(20, 1 << 60), t, 20, 400)
    hard_negatives.threshold_join(q, np.arange(20), x, np.arange(400), wins)
    expected = defaultdict(set)
    for a in range(20):
        for b in range(400):
            if a != b and int(q[a].astype(int) @ x[b].astype(int)) >= t[a]:
                expected[a].add(b)
    assert {a: set(wins.id[a, : wins.held[a]].tolist()) for a in range(20) if wins.held[a]} == expected
    assert sum(map(len, expected.values())) > 0


def test_operator_reads_all_rows(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in df.withColumn("label", hard_negatives.relabelled()).collect()]
    assert got(hard_negatives.mine(df, 50, hard_negatives.relabelled())) == plain(rows, 50)
    assert df.where(F.col("vec_id") % 50 == 0).count() > 0
