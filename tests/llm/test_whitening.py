import numpy as np
import pytest

from marketlane.llm import whitening


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, "k", 0.5) for i, v in rows], "vec_id long, embedding array<float>, n int, `a.b` string, x double")


def plain(rows, wanted=16):
    """Dense reference: eigenvectors from numpy, whole numbers in Python."""
    whole = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], dtype=object).astype(float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    out = {}
    for at, (i, x) in enumerate(whole):
        d = [n * c - s for c, s in zip(x, sums)]
        out[at] = (i, sum(c * c for c in d), (np.array(d, dtype=float) / n) @ vectors / np.sqrt(values))
    return n, values, np.trace(y.T @ y / n), out


def compare(df, rows):
    n, values, trace, expected = plain(rows)
    got = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    assert len(got) == len({(i, d) for i, d, _ in expected.values()})
    signs = {}
    for i, deviation, white in expected.values():
        own = got[(i, deviation)]
        assert sorted(own) == list(range(1, len(values) + 1))
        for k, r in own.items():
            assert r["n"] == n and r["explained"] == pytest.approx(values[k - 1] / trace, rel=1e-9) and r["identity_error"] < 1e-9
            if abs(white[k - 1]) > 1e-3:
                signs.setdefault(k, np.sign(r["whitened"] * white[k - 1]))
            assert r["whitened"] * signs.get(k, 1) == pytest.approx(white[k - 1], abs=1e-7)


def test_equals_dense_reference(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.standard_normal(24) * np.linspace(3, 0.2, 24)).tolist()) for k in range(400)]
    rows += [(k, rows[7][1]) for k in range(400, 600)]  # copies count once in the fit and are whitened all the same
    compare(whitening.whiten(frame(spark, rows)), rows)


def test_wide_range_of_components(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(18) * 10.0 ** rng.integers(0, 4)).tolist()) for k in range(120)]
    compare(whitening.whiten(frame(spark, rows)), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [1.0, -inf]), (5, []), (6, [1.0, 2.0, 3.0])]
    good = [(10, [0.0, 0.0]), (11, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [0.0, 2.0]), (None, [3.0, 1.0]), (13, [-1.0, 0.5])]
    df = whitening.whiten(frame(spark, bad + good))
    rows = df.collect()
    assert len(rows) == 2 * len(good) and {r["n"] for r in rows} == {5} and {r["component"] for r in rows} == {1, 2}
    compare(df, [good[0], good[1], *good[3:]])
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, bad[:5])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # no variance
    line = whitening.whiten(frame(spark, [(k, [float(k), 2.0 * k, 5.0]) for k in range(10)])).collect()
    assert {r["component"] for r in line} == {1} and {round(r["explained"], 12) for r in line} == {1.0}


def test_dense_methods():
    rng = np.random.default_rng(3)
    for case in range(6):
        size = (1, 2, 3, 17, 40, 64)[case]
        q, _ = np.linalg.qr(rng.standard_normal((size, size)))
        values = np.sort(rng.random(size))[::-1]
        if case == 4:
            values[:10] = values[0]  # one cluster of equal eigenvalues
        matrix = (q * values) @ q.T
        matrix = (matrix + matrix.T) / 2
        d, e, t = whitening.tridiagonal(matrix)
        full = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
        assert np.allclose(t.T @ matrix @ t, full, atol=1e-13) and np.allclose(t.T @ t, np.eye(size), atol=1e-13)
        wanted = min(16, size)
        assert np.allclose(whitening.leading_values(d, e, wanted), values[:wanted], atol=1e-13)
        found, vectors = whitening.leading_vectors(matrix, 16)
        assert np.allclose(found, values[:wanted], atol=1e-13)
        assert np.allclose(vectors.T @ vectors, np.eye(wanted), atol=1e-11)
        assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12
    found, vectors = whitening.leading_vectors(np.eye(20), 16)
    assert np.allclose(found, 1.0) and np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-11)


def test_packing_is_by_value():
    rows = np.array([[0, 127], [0, -128], [1, 40_000], [1 << 40, -3], [0, 127]])
    packed = whitening._pack(rows)
    assert packed[0] == packed[4] and len(set(packed)) == 4
    assert (whitening._unpack(packed, 2) == rows).all()


def test_deviation_beyond_a_long():
    total = np.array([0, 0])
    assert whitening.deviations(np.array([[1, 2], [1 << 33, 0]]), 3, total) == [45, None]
