"""Whitening against a plain eigendecomposition, and its edges."""

import numpy as np
import pytest

from gradus.llm import base, whitening
from gradus.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, x int, n string, component int"


def plain(vectors):
    """Whole vectors, their distinct list, mean and covariance, by plain numpy."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    return x, fit, centred.T @ centred / len(fit)


def test_query_against_numpy(spark, sf):
    rows = {r["vec_id"]: r["embedding"] for r in base.table(spark, sf, "embeddings").collect()}
    ids = sorted(rows)
    x, fit, v = plain([rows[i] for i in ids])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    want = (x - fit.mean(0)) @ vectors / np.sqrt(values)
    got = QUERIES["op11_whitening"](spark, sf).toPandas()
    assert len(got) == 16 * len(ids) and set(got["n"]) == {len(fit)} and got["identity_error"].max() < 1e-9
    found = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((found * want).sum(0))
    assert np.allclose(found * signs, want, atol=1e-6)
    shares = got.drop_duplicates("component").set_index("component")["explained"].sort_index().to_numpy()
    assert np.allclose(shares, values / np.trace(v), rtol=1e-10)
    deviations = got.drop_duplicates("vec_id").set_index("vec_id")["deviation"]
    sums = [int(s) for s in fit.sum(0)]
    for i, row in zip(ids, x.tolist()):
        assert deviations[i] == sum((len(fit) * a - s) ** 2 for a, s in zip(row, sums))


def test_factor_and_rotations():
    pick = np.random.default_rng(3)
    for d, rank in ((1, 1), (7, 7), (12, 5), (31, 31)):
        half = pick.normal(size=(d, rank)) * 10.0 ** pick.integers(-3, 4, rank)
        a = half @ half.T
        g = whitening.pivoted_cholesky(a)
        assert g.shape[1] <= rank or d == rank
        assert np.allclose(g @ g.T, a, rtol=1e-9, atol=1e-9 * np.abs(a).max())
        turned = whitening.one_sided_jacobi(g)
        norms = (turned * turned).sum(0)
        assert np.allclose(norms, np.linalg.eigvalsh(a)[::-1][: len(norms)], rtol=1e-8, atol=1e-10 * norms[0])
        unit = turned / np.sqrt(norms)
        assert np.allclose(unit.T @ unit, np.eye(len(norms)), atol=1e-10)


def test_rows_that_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -2.0]), (2, [1.5, 0.25, 3.0]), (2, [1.5, 0.25, 3.0]), (None, [-1.0, 2.0, 0.125]), (3, [4.0, 4.0, 4.0])]
    bad = [(4, None), (5, [1.0, None, 2.0]), (6, [1.0, nan, 2.0]), (7, [inf, 0.0, 0.0]), (8, []), (9, [1.0]), (10, [1e30, 0.0, 0.0])]
    table = spark.createDataFrame([(i, v, 1, "n", 2) for i, v in good + bad], SCHEMA).repartition(4)
    found = whitening.whiten(table).collect()
    assert sorted({str(r["vec_id"]) for r in found}) == ["1", "2", "3", "None"]
    assert {r["n"] for r in found} == {4} and {r["component"] for r in found} == {1, 2, 3} and len(found) == 15
    x, fit, _ = plain([v for _, v in good])
    for (i, _), row in zip(good, x.tolist()):
        want = sum((4 * a - int(s)) ** 2 for a, s in zip(row, fit.sum(0)))
        assert {r["deviation"] for r in found if r["vec_id"] == i} == {want}


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_varies(spark, vectors):
    table = spark.createDataFrame([(k, v, 1, "n", 2) for k, v in enumerate(vectors)], SCHEMA)
    assert whitening.whiten(table).collect() == []


def test_wide_deviations_are_exact():
    x = np.array([[1 << 45, 3], [5, -(1 << 44)], [1 << 20, 7]])
    sums, n = (int(x[:, 0].sum()), int(x[:, 1].sum())), 3
    want = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    assert whitening._deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]
