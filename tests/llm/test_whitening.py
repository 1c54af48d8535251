"""Components and whitened vectors against a dense decomposition."""

import numpy as np
import pytest

from quotegrid.llm import whitening as wh


def frame(spark, vectors, extra=()):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows + list(extra), "vec_id long, embedding array<float>").repartition(3)


def dense(vectors):
    x = np.floor(np.array(vectors, dtype=np.float32).astype(float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    return ((n * x - s) ** 2).sum(axis=1), c, values[::-1], vectors[:, ::-1]


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(7)
    return (r.standard_normal((400, 40)) * np.linspace(3, 1, 40) @ np.linalg.qr(r.standard_normal((40, 40)))[0]).round(3)


def test_whitened_equals_dense(spark, vectors):
    bad = [(900, None), (901, [float("nan")] * 40), (902, [float("inf")] + [0.0] * 39), (903, [None] + [0.0] * 39), (904, []), (905, [1.0])]
    got = wh.whiten(frame(spark, vectors, bad)).toPandas()
    deviation, c, values, basis = dense(vectors)
    assert len(got) == 400 * 8 and set(got.n) == {400}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = c @ basis[:, :8] / np.sqrt(values[:8])
    signs = np.sign((wide * want).sum(axis=0))
    assert np.abs(wide * signs - want).max() < 1e-10
    assert got[got.component == 3].sort_values("vec_id").deviation.tolist() == deviation.tolist()
    assert np.allclose(got.groupby("component").explained.first(), values[:8] / values.sum(), rtol=1e-12)
    assert got.identity_error.max() < 1e-12 and got.identity_error.nunique() == 1


def test_close_eigenvalues_need_the_filter():
    """Two leading eigenvalues 0.1 % above a flat rest: certified, and by far fewer passes than plain iteration takes."""
    r = np.random.default_rng(2)
    basis = np.linalg.qr(r.standard_normal((200, 200)))[0]
    values = np.concatenate([[1.002, 1.001], np.linspace(1.0, 0.5, 198)])
    matrix = (basis * values) @ basis.T
    found = wh.leading_components(lambda q: matrix @ q, 200, 2)
    assert np.abs(np.abs((found.vectors * basis[:, :2]).sum(axis=0)) - 1).max() < 1e-12
    assert np.allclose(found.values, values[:2], rtol=1e-13)
    assert found.passes < 400  # the gap of 0.1 % costs plain iteration some 30,000


def test_fewer_dimensions_and_less_spread(spark):
    r = np.random.default_rng(1)
    got = wh.whiten(frame(spark, r.standard_normal((50, 3)))).toPandas()
    assert sorted(set(got.component)) == [1, 2, 3] and got.identity_error.max() < 1e-9
    line = np.outer(np.arange(20), np.ones(12))  # spread in one dimension only
    got = wh.whiten(frame(spark, line)).toPandas()
    assert set(got.component) == {1} and abs(got.explained.iloc[0] - 1) < 1e-12


def test_degenerate_tables(spark):
    assert wh.whiten(frame(spark, [])).count() == 0
    assert wh.whiten(frame(spark, [None, [None, 1.0]])).count() == 0
    assert wh.whiten(frame(spark, [[1.0, 2.0]] * 5)).count() == 0  # no spread, no component


def test_null_and_repeated_ids_and_clashing_columns(spark):
    rows = [(None, [1.0, 2.0], 1), (None, [2.0, 1.0], 2), (4, [0.5, 3.0], 3), (4, [0.5, 3.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    got = wh.whiten(df).toPandas()
    assert len(got) == 8 and got.vec_id.isna().sum() == 4 and set(got.n) == {4}


def test_deviation_beyond_long_steps(spark):
    rows = [(0, [1e9, 0.0]), (1, [0.0, 1.0]), (2, [1e12, 0.0])]
    got = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    x = [[int(c * 1024) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    exact = [sum((3 * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    first = got[got.component == 1].sort_values("vec_id").deviation.tolist()
    assert [None if e >= 1 << 63 else e for e in exact] == [None if v != v else int(v) for v in first]


def test_uncertified_components_are_refused(monkeypatch):
    matrix = np.diag(np.linspace(1.0, 0.999, 100))
    monkeypatch.setattr(wh, "ROUNDS", 1)
    with pytest.raises(ArithmeticError):
        wh.leading_components(lambda q: matrix @ q, 100, 8)
