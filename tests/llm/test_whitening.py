"""Whitened components against a dense solver and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, start=0):
    rows = [(start + i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def lifted(vectors):
    return np.floor(np.asarray(vectors, np.float32).astype(float) * 1024).astype(np.int64) + 100_000


def reference(vectors, components=8):
    x = lifted(vectors)
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    white = centred @ found[:, order] / np.sqrt(values[order])
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return white, exact, values[order] / values.sum()


def random_vectors(n, d, seed=3, spread=None):
    rng = np.random.default_rng(seed)
    spread = np.geomspace(1, 0.05, d) if spread is None else spread
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    return (rng.standard_normal((n, d)) * spread) @ turn + rng.standard_normal(d)


def check(rows, vectors, components=8):
    white, exact, explained = reference(vectors, components)
    got = rows.toPandas()
    k = white.shape[1]
    assert len(got) == len(vectors) * k and (got["n"] == len(vectors)).all()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((wide * white).sum(axis=0))
    np.testing.assert_allclose(wide * signs, white, atol=1e-7)
    by_id = got.drop_duplicates("vec_id").sort_values("vec_id")
    assert by_id["deviation"].tolist() == exact
    np.testing.assert_allclose(got.drop_duplicates("component").sort_values("component")["explained"], explained, rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-8


def test_equals_a_dense_solver(spark):
    vectors = random_vectors(400, 24)
    check(W.report(frame(spark, vectors).repartition(5)), vectors)


def test_fewer_dimensions_than_components(spark):
    vectors = random_vectors(50, 3)
    check(W.report(frame(spark, vectors)), vectors, 3)


def test_rows_without_usable_vectors_take_no_part(spark):
    vectors = random_vectors(60, 6)
    bad = [None, [], [1.0, None, 1, 1, 1, 1], [float("nan")] * 6, [1, 1, float("inf"), 1, 1, 1], [1e30] + [0] * 5, [1.0, 2.0]]
    both = frame(spark, vectors).unionByName(frame(spark, bad, 1_000))
    check(W.report(both.withColumns({c: F.lit("x") for c in ("key", "vector", "at", "n", "whitened")})), vectors, 6)


def test_repeated_rows_and_null_ids_are_rows(spark):
    vectors = random_vectors(40, 4)
    twice = frame(spark, vectors).unionByName(frame(spark, vectors)).withColumn("vec_id", F.nullif("vec_id", F.lit(3)))
    rows = W.report(twice)
    assert rows.count() == 80 * 4 and rows.where("vec_id IS NULL").count() == 8
    assert rows.first()["n"] == 80


def test_no_variance_no_components(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None]):
        rows = W.report(frame(spark, vectors))
        assert rows.collect() == []
        assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_directions_without_variance_are_left_out(spark):
    flat = random_vectors(80, 3) @ np.eye(3, 7)
    rows = W.report(frame(spark, flat))
    assert {r.component for r in rows.select("component").distinct().collect()} == {1, 2, 3}
    assert rows.first()["identity_error"] < 1e-8


def test_large_entries_stay_exact(spark):
    vectors = np.array([[1e9, 1.0], [-1e9, 2.0], [3e9, 7.0], [5.0, -8.0]], np.float32)
    got = W.report(frame(spark, vectors)).toPandas().drop_duplicates("vec_id").sort_values("vec_id")
    x, n = lifted(vectors), 4
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, x.sum(axis=0))) for row in x]
    assert got["deviation"].isna().tolist() == [e >= 1 << 63 for e in exact]


@pytest.mark.parametrize("values", [
    [5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 1, 0.5],  # a cluster across the cut
    [9, 8, 7, 6, 5, 4, 3, 2, 1, 0.5, 0.2, 0.1],
    [1, 1e-3, 1e-6, 1e-9, 1e-10, 0, 0, 0],
    [4, 4 - 1e-10, 4 - 2e-10, 1, 1, 0.3, 0.2, 0.1, 0.05, 0.01],
])
def test_eigenpairs_of_awkward_spectra(spark, values):
    values = np.array(values, float)
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((len(values),) * 2))[0]
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = W.eigenpairs(spark, matrix, 8)
    wanted = np.sort(values)[::-1][:8]
    wanted = wanted[wanted > 1e-13 * values.sum()]
    np.testing.assert_allclose(found, wanted, rtol=1e-4, atol=1e-13)
    np.testing.assert_allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-12)
    np.testing.assert_allclose(matrix @ vectors.T, vectors.T * found, atol=1e-12)


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for _ in range(30):
        a = rng.standard_normal((9, 9))
        a = a + a.T
        a[2] = a[:, 2] = 0
        assert W.negatives(a) == (np.linalg.eigvalsh(a) < -1e-12).sum()
    assert W.negatives(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
