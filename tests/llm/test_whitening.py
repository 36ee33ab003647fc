"""Whitening against plain NumPy over all rows."""

import math

import numpy as np
import pytest

from gridloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, components=8, distinct=False):
    """n, deviation, |whitened| and explained of the rows of a list of vectors, without groups."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0) if distinct else x
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    z = np.abs((x - sums / n) @ axes / np.sqrt(values))
    return n, [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x], z, values / np.trace(centred.T @ centred / n)


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v) for i, v in zip(ids, vectors)], SCHEMA)


def compare(rows, ids, want, components=8):
    n, deviation, z, explained = want
    found = {}
    for r in rows:
        found.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == len(ids) * components
    for i, at in zip(ids, range(len(ids))):
        for c in range(components):
            r = found[i][c + 1]
            assert (r.n, r.deviation) == (n, deviation[at])
            assert math.isclose(abs(r.whitened), z[at][c], rel_tol=1e-6, abs_tol=1e-6) and math.isclose(r.explained, explained[c], rel_tol=1e-6)
            assert r.identity_error < 1e-9


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(0)
    different = (rng.normal(size=(150, 12)) * np.linspace(2, 0.2, 12)).astype(np.float32).tolist()
    return different + [different[0]] * 200 + different[3:9]


@pytest.mark.parametrize("fit", ["counts", "one"])
def test_whitening_equals_numpy_and_a_hot_vector_is_spread(spark, vectors, fit):
    rows = whitening.whiten(table(spark, vectors).repartition(6), fit=fit).collect()
    compare(rows, range(len(vectors)), plain(vectors, distinct=fit == "one"))


def test_query_equals_numpy_on_the_table(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(whitening.op13(spark, sf_dir).collect(), [r.vec_id for r in given], plain([r.embedding for r in given]))


def test_rows_that_are_left_out(spark, vectors):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None] * 6, [nan] * 12, [inf] + [0.0] * 11, [3e38] * 12, [1.0, 2.0]]
    rows = whitening.whiten(table(spark, vectors + bad)).collect()
    compare(rows, range(len(vectors)), plain(vectors))


def test_null_and_repeated_ids_and_other_columns(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(40, 3)).astype(np.float32).tolist()
    ids = [None] * 20 + [5] * 20
    df = table(spark, vectors, ids).selectExpr("*", "1 AS n", "'x' AS key", "embedding AS whitened", "2 AS component")
    rows = whitening.whiten(df).collect()
    n, deviation, z, _ = plain(vectors, 3)
    for k, part in ((None, slice(0, 20)), (5, slice(20, 40))):
        got = sorted((r.deviation, r.component, round(abs(r.whitened), 6)) for r in rows if r.vec_id == k)
        assert got == sorted((d, c + 1, round(float(x[c]), 6)) for d, x in zip(deviation[part], z[part]) for c in range(3))


def test_without_variance_and_without_rows(spark):
    one = whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).collect()
    assert len(one) == 10 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(5, 0, None, None, None)}
    flat = whitening.whiten(table(spark, [[0.5, float(i)] for i in range(6)])).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.explained == (1.0 if r.component == 1 else 0.0) for r in flat)
    assert whitening.whiten(table(spark, [None, []])).collect() == []


def test_large_entries_stay_exact_or_become_null(spark):
    vectors = [[2.0 ** 40, 1.0], [2.0 ** 40 + 2.0 ** 20, 2.0], [-5.0, 3.0]]
    n, deviation, _, _ = plain(vectors, 2)
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, vectors)).collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, vectors), fit="none")
