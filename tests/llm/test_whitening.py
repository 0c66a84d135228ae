"""Whitening against numpy's decompositions, exact sums against Python integers."""

import math

import numpy as np
import pytest

from lociweave.llm import qd, whitening
from lociweave.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n long, v string, id int"


def matrices():
    rng = np.random.default_rng(1)
    left, right = (np.linalg.qr(rng.normal(size=(30, 30)))[0] for _ in range(2))
    low = np.zeros((12, 12))
    low[:3] = rng.normal(size=(3, 12))
    yield rng.normal(size=(40, 40))
    yield np.triu(rng.normal(size=(25, 25)))
    yield np.eye(9) * 3
    yield low
    yield np.zeros((4, 4))
    yield np.array([[2.0]])
    yield left @ np.diag(np.r_[[5] * 8, [3] * 8, [1] * 14]) @ right
    yield left @ np.diag(1 + 1e-9 * np.arange(30)) @ right
    yield left @ np.diag(2.0 ** -np.arange(30)) @ right
    yield np.diag(np.abs(np.arange(-10, 11.0))) + np.diag(np.ones(20), 1)


@pytest.mark.parametrize("matrix", list(matrices()))
def test_qd_solver(matrix):
    values, vectors = qd.leading(matrix, 16)
    want = np.linalg.svd(matrix, compute_uv=False) ** 2
    top = want[0] or 1
    assert len(values) == min(16, int((want > top * 1e-25).sum()))
    np.testing.assert_allclose(values, want[: len(values)], rtol=1e-9, atol=1e-14 * top)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-11)
    np.testing.assert_allclose(matrix.T @ (matrix @ vectors), vectors * values, atol=1e-12 * top)


def plain(rows, most=16):
    """Contract values by definition: exact integers, then numpy's symmetric eigensolver."""
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in fine]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    variances, directions = np.linalg.eigh(centred.T @ centred / n)
    variances, directions = variances[::-1], directions[:, ::-1]
    k = min(most, int((variances > 1e-9 * variances[0]).sum()))
    out = {}
    for at, ((i, _), v) in enumerate(zip(fine, x)):
        gaps = [n * c - s for c, s in zip(v, sums)]
        y = (np.array(gaps) / n) @ directions[:, :k] / np.sqrt(variances[:k])
        out[i, at] = (n, sum(g * g for g in gaps), y)
    return out, variances[:k] / variances.sum()


def compare(spark, rows):
    vectors = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(3)
    got = whitening.whitened_vectors(vectors).toPandas()
    want, explained = plain(rows)
    k = len(explained)
    assert len(got) == k * len(want)
    found = sorted(
        (tuple(g.sort_values("component").whitened), g.n.iloc[0], g.deviation.iloc[0]) for _, g in got.groupby(np.repeat(np.arange(len(want)), k))
    )
    mine, theirs = np.array([f[0] for f in found]), np.array([w[2] for w in want.values()])
    # the sign of a component is free: fix it by its sum of cubes on both sides
    mine, theirs = (m * np.sign((m**3).sum(axis=0)) for m in (mine, theirs))
    np.testing.assert_allclose(sorted(mine.tolist()), sorted(theirs.tolist()), atol=1e-8)
    assert sorted(f[1:] for f in found) == sorted(w[:2] for w in want.values())
    for c, share in enumerate(explained, 1):
        np.testing.assert_allclose(got[got.component == c].explained, share, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    return got


def test_whitening_matches_the_definition(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 20)) @ np.diag(np.linspace(3, 0.3, 20))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(7, rows[7][1]), (1000, rows[8][1]), (None, rows[9][1])]  # repeats count once in the fit
    rows += [(2000, None), (2001, [None] + [1.0] * 19), (2002, [float("nan")] * 20), (2003, [float("-inf")] + [0.0] * 19)]
    got = compare(spark, rows)
    assert set(got.vec_id.dropna()) == {*range(300), 1000} and got.component.max() == 16


def test_fewer_dimensions_and_large_entries(spark):
    rng = np.random.default_rng(4)
    compare(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 3)))])
    # entries that need more than four bytes, and products that need more than eight
    rows = [(i, [float(a) * 2.0**40, float(b)]) for i, (a, b) in enumerate(rng.integers(-9, 9, size=(40, 2)))]
    vectors = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    got = whitening.whitened_vectors(vectors).toPandas()
    want, _ = plain(rows)
    exact = {i: d for (i, _), (_, d, _) in want.items()}
    for i, g in got.groupby("vec_id"):
        assert g.deviation.isna().all() if exact[i] >= 1 << 63 else set(g.deviation) == {exact[i]}
    assert got.identity_error.iloc[0] < 1e-6


def test_tables_without_variance(spark):
    def rows_of(rows):
        return whitening.whitened_vectors(spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)).collect()

    assert rows_of([]) == [] and rows_of([(1, None)]) == [] and rows_of([(1, [])]) == []
    assert rows_of([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    line = rows_of([(i, [float(i), 2.0 * i, 5.0]) for i in range(6)])
    assert len(line) == 6 and {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)
    mixed = rows_of([(1, [1.0]), (2, [1.0, 2.0]), (3, [2.0, 5.0]), (4, [0.0, 1.0])])
    assert {r.vec_id for r in mixed} == {2, 3, 4}


def test_query_on_the_embeddings(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op12_whitening"](spark, folder).toPandas()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, explained = plain(rows)
    assert len(got) == len(want) * 16
    for (i, _), (n, far, y) in want.items():
        mine = got[got.vec_id == i].sort_values("component")
        assert set(mine.n) == {n} and set(mine.deviation) == {far}
        np.testing.assert_allclose(np.abs(mine.whitened), np.abs(y), atol=1e-7)
        np.testing.assert_allclose(mine.explained, explained, rtol=1e-9)
