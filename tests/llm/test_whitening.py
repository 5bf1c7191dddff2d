"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinshelf.llm import whitening


def plain(vectors, k):
    """{row place: (deviation, whitened)}, explained shares; vectors are usable."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, centred = len(x), x - x.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(k, int((e > e[0] * len(e) * 1e-14).sum())) if e[0] > 0 else 0
    deviation = [sum(int(n * a - s) ** 2 for a, s in zip(row, x.sum(axis=0))) for row in x]
    return deviation, centred @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def matrix(rows, ids):
    got = {(r["id"], r["component"]): r for r in rows}
    k = max(r["component"] for r in rows)
    return np.array([[got[i, c]["whitened"] for c in range(1, k + 1)] for i in ids])


@pytest.mark.parametrize("n,d,height,parts", [(300, 12, 16, 3), (50, 40, 1024, 7), (400, 3, 7, 1)])
def test_whitening_equals_the_plain_form(spark, n, d, height, parts):
    pick = np.random.default_rng(n)
    vectors = (pick.normal(size=(n, d)) * pick.uniform(0.2, 3, d) + 1).tolist()
    vectors[n // 3:n // 2] = [vectors[0]] * (n // 2 - n // 3)  # a group of equal rows
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = whitening.whiten(df.repartition(parts), rows=height).collect()
    deviation, whitened, explained = plain(vectors, 32)
    assert len(rows) == n * whitened.shape[1]
    got = matrix(rows, range(n))
    sign = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got - sign * whitened).max() < 1e-6
    for r in rows:
        assert r["n"] == n and r["deviation"] == deviation[r["id"]]
        assert r["identity_error"] < 1e-4
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-4
    covariance = got.T @ got / n - np.eye(got.shape[1])
    assert abs(np.abs(covariance).max() - rows[0]["identity_error"]) < 1e-9


def test_rows_without_a_usable_vector_take_no_part(spark):
    good = [[0.5, 1.0], [2.0, -1.0], [1.0, 4.0], [0.0, 0.1]]
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [1e300, 0.0], [1.0, 2.0, 3.0]]
    rows = [(i, v, "x", 1) for i, v in enumerate(good + bad)]
    rows += [(1, [2.0, -1.0], "y", 2), (None, [3.0, 3.0], "z", 3)]  # a repeated id, a null id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string, x int")
    got = whitening.whiten(df).collect()
    assert sorted(str(r["id"]) for r in got) == sorted(["0", "1", "1", "2", "3", "None"] * 2)
    deviation, _, _ = plain([*good, [2.0, -1.0], [3.0, 3.0]], 32)
    assert {r["deviation"] for r in got if r["id"] is None} == {deviation[-1]}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [None, None]])
def test_no_direction_no_component(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<float>")
    got = whitening.whiten(df)
    assert got.count() == 0 and got.schema["id"].dataType.simpleString() == "int"


def test_a_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(1, [1e12]), (2, [0.0]), (3, [1.0])], "vec_id long, embedding array<double>")
    rows = {r["id"]: r["deviation"] for r in whitening.whiten(df.withColumn("n", F.lit(0))).collect()}
    assert rows[1] is None and set(rows) == {1, 2, 3}
