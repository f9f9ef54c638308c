"""Whitening against numpy's eigenvalues and exact whole numbers."""

import math
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayline.llm import whitening
from assayline.llm.queries import QUERIES
from assayline.llm.whitening import one_sided_jacobi, pivoted_cholesky, whiten

GIVEN = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>"


def check(made, vectors, most=16):
    """Compare the rows of a result with a direct solution."""
    ints = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in vectors])
    fit = np.unique(ints, axis=0)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    mean = np.array([float(Fraction(s, n) - 1_000_000) for s in sums])
    centred = (fit - 1_000_000) - mean
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(most, int((values > len(values) * whitening.EPS * values.sum()).sum()))
    assert len(made) == count * len(vectors)
    rows = made.sort_values(["vec_id", "component"])
    assert rows.n.eq(n).all() and rows.identity_error.nunique() == 1
    assert rows.identity_error.iloc[0] < 1e-8
    deviation = {
        i: sum((n * int(x) - s) ** 2 for x, s in zip(row, sums, strict=True))
        for (i, _), row in zip(vectors, ints, strict=True)
    }
    assert rows.deviation.tolist() == [deviation[i] for i in rows.vec_id]
    got = rows.whitened.to_numpy().reshape(-1, count)
    order = np.argsort([i for i, _ in vectors], kind="stable")
    want = (((ints - 1_000_000) - mean) @ axes[:, :count] / np.sqrt(values[:count]))[order]
    signs = np.sign((got * want).sum(0))
    assert np.allclose(got, want * signs, atol=1e-6)
    explained = rows.explained.to_numpy().reshape(-1, count)
    assert np.allclose(explained, values[:count] / np.trace(v), rtol=1e-10)


def spread(seed, n, dims, offset=0.0):
    pick = np.random.default_rng(seed)
    base = pick.normal(size=(n, dims)) * np.geomspace(4, 0.2, dims) @ pick.normal(size=(dims, dims))
    return [(i, [float(np.float32(c)) for c in row + offset]) for i, row in enumerate(base)]


@pytest.mark.parametrize("dims,offset", [(3, 0.0), (8, 0.0), (24, 3000.0), (33, -70.0)])
def test_whitening_equals_a_direct_solution(spark, dims, offset):
    rows = spread(dims, 400, dims, offset)
    rows += [(1000 + k, rows[5][1]) for k in range(300)]
    check(whiten(spark.createDataFrame(rows, ROWS).repartition(4)).toPandas(), rows)


def test_query_on_the_given_vectors(spark):
    if not Path(GIVEN).exists():
        pytest.skip("test tables are not here")
    table = spark.read.parquet(f"{GIVEN}/embeddings.parquet").select("vec_id", "embedding").collect()
    made = QUERIES["op13_embedding_whitening"](spark, GIVEN).toPandas()
    check(made, [(r.vec_id, r.embedding) for r in table])


def test_factors():
    pick = np.random.default_rng(2)
    for dims, rank in ((1, 1), (5, 5), (12, 7), (31, 30)):
        root = pick.normal(size=(dims, rank)) * 10.0 ** pick.integers(-3, 4, rank)
        matrix = root @ root.T
        factor = pivoted_cholesky(matrix)
        assert factor.shape[1] <= dims
        assert np.allclose(factor @ factor.T, matrix, atol=1e-12 * np.abs(matrix).max())
        pivots = np.argsort([-np.count_nonzero(row == 0.0) for row in factor], kind="stable")
        assert np.allclose(np.triu(factor[pivots], 1)[: factor.shape[1]], 0)
        values, axes = one_sided_jacobi(factor)
        assert np.allclose((axes * values) @ axes.T, matrix, atol=1e-12 * np.abs(matrix).max())
        assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-13)
        assert (np.diff(values) <= 0).all()
    # Small eigenvalues of a graded matrix keep their digits.
    graded = np.diag([1e12, 1.0, 1e-8]) + 0.0
    assert np.allclose(one_sided_jacobi(pivoted_cholesky(graded))[0], [1e12, 1.0], rtol=1e-14)


def test_edge_rows_of_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = spread(4, 60, 5)
    odd = [
        (100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [nan, 1.0, 1.0, 1.0, 1.0]),
        (104, [1.0, inf, 1.0, 1.0, 1.0]), (105, [1.0, 2.0]), (106, [1.0] * 6),
    ]
    names = ("id", "x", "n", "component", "deviation")
    df = spark.createDataFrame(rows + odd + rows[:2], ROWS)
    df = df.withColumns({c: F.lit("clash") for c in names})
    made = whiten(df).toPandas()
    assert sorted(made.vec_id.unique()) == list(range(60))
    assert len(made) == 62 * len(made.component.unique())
    check(made.drop_duplicates(), rows)
    wide = whiten(spark.createDataFrame([(None, [1e30, 2.0]), (1, [-1e30, 3.0])], ROWS)).toPandas()
    assert wide.deviation.isna().all() and wide.component.tolist() == [1, 1]
    assert np.allclose(sorted(wide.whitened), [-1, 1])


def test_constant_and_dependent_dimensions(spark):
    rows = [(i, [*v, 7.0, v[0], 2 * v[1]]) for i, v in spread(6, 80, 3)]
    rows = [(i, [math.floor(64 * c) / 64 for c in v]) for i, v in rows]
    check(whiten(spark.createDataFrame(rows, ROWS)).toPandas(), rows)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 5, [(1, [])]):
        made = whiten(spark.createDataFrame(rows, ROWS))
        assert made.columns[:3] == ["vec_id", "component", "n"] and made.count() == 0


def test_too_many_dimensions_are_refused(spark):
    with pytest.raises(ValueError):
        whiten(spark.createDataFrame([(1, [0.0] * (whitening.MOST_DIMS + 1))], ROWS))
