import numpy as np
import pytest

from marketlane.llm import ann


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, label int, score double")


def plain(rows, step, k=20):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, dtype=np.float32).astype(np.float64)
    out = []
    for q in sorted(i for i in ok if i % step == 0):
        scored = [(-float(np.cumsum(ok[q] * v)[-1]), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("query_block,candidate_block", [(1024, 4096), (7, 33)])
def test_blocks_equal_brute_force(spark, query_block, candidate_block):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(24).astype(np.float32).tolist()) for k in range(500)]
    rows += [(k, rows[20][1]) for k in range(500, 640)]  # one vector a hundred times: all ties
    df = frame(spark, rows)
    queries = df.where("vec_id % 20 = 0")
    got = ann.nearest(queries, df, query_block=query_block, candidate_block=candidate_block).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 20)


def test_bounds_hold(spark):
    rng = np.random.default_rng(4)
    a, b = rng.standard_normal((50, 64)), rng.standard_normal((80, 64)) * rng.lognormal(size=(80, 1))
    qa, sa, la, ra = ann.quantised(a)
    qb, sb, lb, rb = ann.quantised(b)
    tile = (qa.astype(int) @ qb.T.astype(int)) * sa[:, None] * sb[None, :]
    slack = la[:, None] * rb[None, :] + ra[:, None] * np.linalg.norm(b, axis=1)[None, :]
    assert (np.abs(tile - a @ b.T) <= slack + 1e-9).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0])]
    rows += [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (3, [1.0, 2.0, 3.0]), (120, [2.0, 2.0]), (None, [1.0, 1.0]), (4, [])]
    got = ann.search_every(frame(spark, rows), 20).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 20)
    assert ann.search_every(frame(spark, rows).limit(0), 20).count() == 0
