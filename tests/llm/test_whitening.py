import math

import numpy as np
import pytest
from lexigraph.llm import queries, whitening

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>"


def reference(x):
    """Distinct rows' eigenvalues and vectors by a dense solver."""
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    return fit, values[::-1], vectors[:, ::-1].T


def check(rows, found, components=4):
    x = np.floor(256 * np.array([v for _, v in rows], float))
    fit, values, vectors = reference(x)
    n, total = len(fit), [int(t) for t in fit.sum(axis=0)]
    by_row = {}
    for r in found:
        by_row.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by_row) == list(range(1, components + 1))
    for c, got in by_row.items():
        assert len(got) == len(rows)
        want = (x - fit.mean(axis=0)) @ vectors[c - 1] / math.sqrt(values[c - 1])
        have = np.array([got[i].whitened for i, _ in rows])
        assert np.allclose(have * np.sign(have @ want), want, atol=1e-9, rtol=0)
        for (i, _), v in zip(rows, x):
            assert got[i].deviation == sum((n * int(a) - t) ** 2 for a, t in zip(v, total)) and got[i].n == n
        first = got[rows[0][0]]
        assert abs(first.explained / (values[c - 1] / values.sum()) - 1) < 1e-9 and first.identity_error < 1e-9


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return whitening.by_component(df, whitening.fit(df)).collect()


@pytest.mark.parametrize("dimension", [3, 30, 90])
def test_against_dense_solver(spark, dimension):
    random = np.random.default_rng(dimension)
    x = random.standard_normal((600, dimension)) @ random.standard_normal((dimension, dimension)) / 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    check(rows, run(spark, rows), min(4, dimension))


def test_copies_count_once(spark):
    random = np.random.default_rng(1)
    x = random.standard_normal((80, 40))
    rows = [(i, x[i % 80 if i < 160 else 5].tolist()) for i in range(700)]
    check(rows, run(spark, rows))


def test_filtered_iteration_with_flat_and_steep_spectra():
    random = np.random.default_rng(2)
    basis = np.linalg.qr(random.standard_normal((200, 200)))[0]
    for values in (np.linspace(1, 2, 200), np.geomspace(1e-6, 1e6, 200), np.concatenate([np.zeros(150), np.linspace(1, 1.1, 50)])):
        matrix = basis @ np.diag(values) @ basis.T
        found, vectors, residuals = whitening.eigen(lambda q: matrix @ q, 200, 4)
        assert np.allclose(found, np.sort(values)[::-1][:4], rtol=1e-12)
        assert residuals.max() < 1e-9 * values.max()
        assert np.allclose(np.abs(np.sum(vectors * basis[:, np.argsort(values)[::-1][:4]], axis=0)), 1, atol=1e-9)


def test_equal_eigenvalues_end():
    values, vectors, residuals = whitening.eigen(lambda q: 3.0 * q, 100, 4)
    assert np.allclose(values, 3) and np.allclose(vectors.T @ vectors, np.eye(4))


def test_odd_rows(spark):
    rows = [
        (1, [0.5, -1.0, 2.0]), (1, [0.5, -1.0, 2.0]), (2, [1.0, float("nan"), 0.0]), (3, [float("inf"), 0.0, 0.0]), (4, None),
        (5, [1.0, None, 2.0]), (None, [-0.001, 0.3, 0.0]), (6, [0.0, 0.0, 0.0]), (7, [0.25]), (8, []), (9, [3.0, 1.0, 0.5]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit(df)
    # 6, 8 and the filled-up rest: zero, (64, 0, 0), and three others.
    assert model.n == 5 and model.dimension == 3
    found = whitening.by_component(df, model).collect()
    assert sorted({str(r.vec_id) for r in found}) == ["1", "6", "7", "8", "9", "None"] and len(found) == 7 * 3


def test_nothing_to_fit(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    for rows in (df, df.filter("false"), spark.createDataFrame([(1, None), (2, [])], SCHEMA)):
        found = whitening.by_component(rows, whitening.fit(rows))
        assert found.count() == 0 and found.columns[:2] == ["vec_id", "component"]


def test_magnitudes(spark):
    rows = [(i, [v, 0.0, float(i)]) for i, v in enumerate([1e300, -1e300, 1e15, -3.0, 1e-300])]
    df = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit(df)
    found = {(r.vec_id, r.component): r for r in whitening.by_component(df, model).collect()}
    assert all(math.isfinite(r.whitened) for r in found.values())
    assert found[0, 1].deviation is None
    x = np.array([[2**62, 5], [-(2**40), 7], [3, 4]], np.int64)
    total = [int(t) for t in x.astype(object).sum(axis=0)]
    want = [sum((3 * int(a) - t) ** 2 for a, t in zip(v, total)) for v in x]
    assert whitening._deviations(x, 3, total) == [w if w < 2**63 else None for w in want]


def test_query(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(rows, queries.op13_whitening(spark, folder).collect())
