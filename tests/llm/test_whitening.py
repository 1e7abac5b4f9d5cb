import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from textgate.llm.whitening import (OFFSET, fit_whitening, jacobi_columns, op11, pivoted_cholesky, principal, whiten)

SCHEMA = "vec_id long, embedding array<float>, n int, component string"


def integer_form(rows):
    return [[int(np.floor(64 * np.float64(np.float32(c)))) + OFFSET for c in v] for v in rows]


@pytest.mark.parametrize("d, rank, spread", [(1, 1, 0), (5, 5, 0), (64, 64, 6), (33, 7, 3), (40, 39, 9)])
def test_principal_against_eigh(d, rank, spread):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, rank)) * 10.0 ** rng.uniform(-spread / 2, 0, rank)
    v = a @ a.T
    left, pivots = pivoted_cholesky(v)
    assert left.shape[1] == rank and np.allclose((left @ left.T), v[pivots][:, pivots], rtol=0, atol=1e-13 * np.abs(v).max())
    assert np.allclose(np.triu(left, 1), 0)
    rotated = jacobi_columns(left)
    cos = rotated.T @ rotated / np.outer(*(2 * [np.linalg.norm(rotated, axis=0)]))
    assert np.abs(cos - np.eye(rank)).max() < 1e-12
    values, vectors = principal(v)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-9, atol=1e-14 * values[0])
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-12 * values[0])


def test_zero_matrix_has_no_component():
    values, vectors = principal(np.zeros((4, 4)))
    assert len(values) == 0 and vectors.shape == (4, 0)


def brute(ids, rows, most=32):
    x = integer_form(rows)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    y = np.array([[c - s / n for c, s in zip(r, sums)] for r in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(most, len(values))
    return {(i, k + 1): (n, dev[r], abs(float(y[r] @ vectors[:, k]) / np.sqrt(values[k])), values[k] / values.sum())
            for r, i in enumerate(ids) for k in range(count)}


def test_against_brute_force_with_invalid_rows(spark):
    rng = np.random.default_rng(1)
    good = (rng.normal(size=(300, 40)) * np.linspace(2, 0.3, 40) + 0.7).astype(np.float32).tolist()
    good += good[:5]  # repeated vectors
    bad = [None, [], [None] * 40, [float("nan")] + [0.0] * 39, [float("inf")] * 40, [3e38] * 40]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)] + [(1000 + i, v, 2, None) for i, v in enumerate(bad)]
    rows += [(2, good[7], 3, None)]  # a repeated id
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = whiten(df, fit_whitening(df)).collect()
    ids = [r[0] for r in rows if r[0] < 1000]
    want = brute(ids, [r[1] for r in rows if r[0] < 1000])
    assert len(got) == len(ids) * 32 and {(r.vec_id, r.component) for r in got} == set(want)
    for r in got:
        if r.vec_id != 2:
            n, dev, size, share = want[r.vec_id, r.component]
            assert (r.n, r.deviation) == (n, dev)
            assert abs(abs(r.whitened) - size) < 1e-8 and abs(r.explained / share - 1) < 1e-9 and r.identity_error < 1e-9


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fit_whitening(empty) == {} and whiten(empty, {}).count() == 0
    one = spark.createDataFrame([(None, [1.0, 2.0], 1, "a")], SCHEMA)
    assert whiten(one, fit_whitening(one)).count() == 0  # no spread: no component
    line = spark.createDataFrame([(1, [0.0, 0.0], 1, None), (None, [1.0, 1.0], 1, None), (3, [2.0, 2.0], 1, None)], SCHEMA)
    got = whiten(line, fit_whitening(line)).collect()
    assert sorted(round(abs(r.whitened), 9) for r in got) == [0, round(1.5 ** 0.5, 9), round(1.5 ** 0.5, 9)]
    assert {(r.component, r.explained, r.deviation) for r in got} == {(1, 1.0, 2 * (3 * 64) ** 2), (1, 1.0, 0)}


def test_each_length_is_a_fit_of_its_own(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3 + i % 2).tolist(), 0, "") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    fits = fit_whitening(df)
    assert {d: f.n for d, f in fits.items()} == {3: 50, 4: 50}
    assert whiten(df, fits).groupBy("component").count().orderBy("component").collect()[-1]["count"] == 50


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2 ** 30 * (i - 3)), float(i)], 0, "") for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, component string")
    x = [[int(np.floor(64 * c)) + OFFSET for c in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((8 * c - s) ** 2 for c, s in zip(x[i], sums)) for i in range(8)}
    got = {r.vec_id: r.deviation for r in whiten(df, fit_whitening(df)).collect()}
    assert got == {i: w if w < 2 ** 63 else None for i, w in want.items()}


def test_query_is_white(spark):
    got = op11(spark, SF001)
    c = got.groupBy("component").agg(F.avg("whitened").alias("m"), F.avg(F.col("whitened") ** 2).alias("v")).collect()
    assert len(c) == 32 and all(abs(r.m) < 1e-9 and abs(r.v - 1) < 1e-9 for r in c)
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9
