"""Whitening against a dense eigendecomposition in numpy."""

import numpy as np
import pytest
from pyspark.sql import types as T

from telmart.llm import whitening
from telmart.llm.shared import table

ROWS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("n", T.StringType()), T.StructField("vector", T.StringType()),
])


def dense(vectors):
    x = np.floor(64 * vectors) + 1000000
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / len(x)
    values, turn = np.linalg.eigh(covariance)
    return centred, values[::-1], turn[:, ::-1]


def compare(found, ids, vectors, components):
    """found: rows of the operator."""
    centred, values, turn = dense(vectors)
    n, k = len(vectors), min(components, vectors.shape[1])
    place = {x: i for i, x in enumerate(ids)}
    whitened, deviation = np.zeros((n, k)), np.zeros(n)
    for row in found:
        whitened[place[row["vec_id"]], row["component"] - 1] = row["whitened"]
        deviation[place[row["vec_id"]]] = row["deviation"]
        assert row["n"] == n and row["identity_error"] <= 1e-10
        assert row["explained"] == pytest.approx(values[row["component"] - 1] / values.sum(), rel=1e-10)
    assert len(found) == n * k
    wanted = centred @ turn[:, :k] / np.sqrt(values[:k])
    sign = np.sign((wanted * whitened).sum(axis=0))
    assert np.abs(whitened - wanted * sign).max() < 1e-8
    x = [[int(v) for v in row] for row in np.floor(64 * vectors) + 1000000]
    sums = [sum(column) for column in zip(*x)]
    for i, row in enumerate(x):
        assert deviation[i] == sum((n * v - s) ** 2 for v, s in zip(row, sums))


def test_all_vectors(spark):
    data = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = data.toPandas()
    vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    compare(whitening.whitened(data).collect(), rows["vec_id"].tolist(), vectors, 32)


def test_more_dimensions_than_the_first_block(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.standard_normal((400, 90)) * np.linspace(2, 0.5, 90)).round(4)
    rows = spark.createDataFrame([(i, x.tolist(), "n", "v") for i, x in enumerate(vectors)], ROWS).repartition(3)
    compare(whitening.whitened(rows, 10).collect(), list(range(400)), vectors, 10)


@pytest.mark.parametrize("d, wanted", [(200, 12), (64, 32), (5, 5), (1, 1)])
def test_solver(d, wanted):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((900, d)) * np.linspace(3, 1, d)
    covariance = x.T @ x / 900
    passes = []

    def product(block):
        passes.append(block.shape)
        return covariance @ block

    values, vectors = whitening.leading(product, d, wanted)
    assert np.abs(values - np.linalg.eigvalsh(covariance)[::-1][:wanted]).max() < 1e-12 * values[0]
    assert np.abs(covariance @ vectors - vectors * values).max() < 1e-13 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13


def test_minres_solves_each_column():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a, right = a + a.T, rng.standard_normal((30, 3))
    found = whitening.minres(lambda x: a @ x, right, 60, 1e-12)
    assert np.abs(a @ found - right).max() < 1e-7


def test_unusable_rows_and_directions_without_variance(spark):
    nan = float("nan")
    vectors = [(1, [1.0, 2.0, 5.0]), (2, [2.0, 4.0, 5.0]), (2, [2.0, 4.0, 5.0]), (None, [0.5, 3.25, 5.0]), (4, [-1.0, 0.0, 5.0])]
    unusable = [(5, None), (6, []), (7, [1.0, nan, 2.0]), (8, [1.0, None, 2.0]), (9, [float("inf"), 1.0, 1.0]), (10, [1.0])]
    rows = spark.createDataFrame([(i, x, "n", None) for i, x in vectors + unusable], ROWS)
    found = whitening.whitened(rows).collect()
    assert {row["vec_id"] for row in found} == {1, 2, 4, None}
    assert {row["component"] for row in found} == {1, 2} and len(found) == 10
    assert {row["n"] for row in found} == {5}
    z = np.array([[r["whitened"] for r in found if r["component"] == c] for c in (1, 2)])
    assert np.abs(z @ z.T / 5 - np.eye(2)).max() < 1e-12


def test_no_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        found = whitening.whitened(spark.createDataFrame([(i, x, "n", "v") for i, x in rows], ROWS))
        assert found.columns[-1] == "identity_error" and found.count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(2 ** 40 * (i % 3)), 1.0 * i]) for i in range(9)]
    found = whitening.whitened(spark.createDataFrame([(i, x, "n", "v") for i, x in rows], ROWS)).collect()
    assert any(row["deviation"] is None for row in found) and all(abs(row["whitened"]) < 4 for row in found)
