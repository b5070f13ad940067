"""Refined eigenvectors and whitening against dense formulas."""

import math

import numpy as np
import pytest

from tillmark.llm import catalog, whitening
from tillmark.llm.eigen import eigenvectors


def random_basis(rng, size):
    return np.linalg.qr(rng.standard_normal((size, size)))[0]


@pytest.mark.parametrize(
    "spectrum",
    [
        np.linspace(1, 50, 40),
        np.concatenate([1 + 1e-9 * np.arange(6), np.linspace(2, 9, 20)]),
        np.concatenate([5 + 1e-12 * np.arange(4), 5 + 1e-6 * np.arange(5), [1e-7, 3.0]]),
        np.concatenate([np.full(10, 7.0), np.full(5, 2.0), [0.0]]),
        10.0 ** -np.arange(12),
    ],
)
def test_eigenvectors_are_refined_to_double_precision(spectrum):
    rng = np.random.default_rng(len(spectrum))
    basis = random_basis(rng, len(spectrum))
    a = (basis * spectrum) @ basis.T
    a = (a + a.T) / 2
    values, x = eigenvectors(a)
    scale = np.abs(spectrum).max()
    assert np.all(np.diff(values) <= 1e-14 * scale)
    assert np.abs(values - np.sort(spectrum)[::-1]).max() < 1e-13 * scale
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-14 * len(a)
    assert np.abs(a @ x - x * values).max() < 1e-14 * scale * len(a)
    single = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    assert np.abs(single.T @ single - np.eye(len(a))).max() > 1e-8  # what there was to refine


def test_clusters_inside_a_cluster_are_told_apart():
    """Neighbours 1e-10 apart: vectors agree with those of the exactly diagonal matrix."""
    spectrum = np.array([1.0, 1 + 1e-10, 1 + 2e-10, 2.0])
    values, x = eigenvectors(np.diag(spectrum))
    assert np.abs(np.abs(x[::-1]).T - np.eye(4)).max() < 1e-6 or np.abs(np.abs(x) - np.eye(4)[:, ::-1]).max() < 1e-6


def test_zero_and_empty_matrices():
    values, x = eigenvectors(np.zeros((3, 3)))
    assert values.tolist() == [0, 0, 0] and x.tolist() == np.eye(3).tolist()
    assert eigenvectors(np.zeros((0, 0)))[0].tolist() == []


def brute(rows, components=16):
    """``{(k, component): (n, deviation, whitened, explained)}`` of the k-th kept row, by the contract's formulas."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    grid = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept]
    fit = sorted({tuple(x) for x in grid})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = []
    for (i, _), x in zip(kept, grid):
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k in range(min(components, len(sums))):
            if values[k] > 1e-12 * values[0] > 0:
                projected = np.dot([c - s / n for c, s in zip(x, sums)], vectors[:, k]) / math.sqrt(values[k])
                found.append((i, k + 1, n, deviation, projected, values[k] / np.trace(covariance)))
    return found


def check(got, want):
    key = lambda r: (r[1], r[0] is None, r[0] or 0, r[3], round(abs(r[4]), 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(r[0], r[1], r[2], r[3]) for r in want]
    for component in {r[1] for r in want}:
        a = np.array([r[4] for r in got if r[1] == component])
        b = np.array([r[4] for r in want if r[1] == component])
        assert np.abs(np.abs(a) - np.abs(b)).max() < 1e-8
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8  # one sign for all rows
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_query_matches_dense_formulas(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in catalog.table(spark, sf, "embeddings").select("vec_id", "embedding").collect()]
    df = catalog.op11_whitening(spark, sf)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    got = df.collect()
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-10
    check([tuple(r)[:6] for r in got], brute(rows))


def test_nulls_repeats_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.normal(0, 5, 6)]) for k in range(40)]
    rows += [(100, rows[0][1]), (0, rows[0][1]), (None, rows[1][1])]
    rows += [(200, None), (201, []), (202, [1.0] * 5 + [None]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id bigint, embedding array<float>, n int, whitened string")
    single = [(i, [float(np.float32(c)) for c in v] if v and None not in v else v) for i, v in rows if i != 205]
    got = whitening.whiten(df.repartition(5)).collect()
    check([tuple(r)[:6] for r in got], brute(single))
    assert len({r["vec_id"] for r in got}) == 42 and len(got) == 43 * 6


def test_few_or_no_vectors(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 1.0])], kind)).collect()
    assert [(r["component"], r["n"], round(abs(r["whitened"]), 9), round(r["explained"], 9)) for r in two] == [(1, 2, 1.0, 1.0)] * 2


def test_huge_entries_saturate_and_deviations_stay_exact(spark):
    rows = [(1, [3e38, 1.0]), (2, [0.0, 2.0]), (3, [5e7, 3.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and all(r["deviation"] is None for r in got)
    rows = [(k, [float(10**7 * k), 1.0 * k]) for k in range(1, 4)]
    kept = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r["deviation"] for r in kept} == {r[3] for r in brute(rows)}


def test_partial_sums_meet_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    vectors = spark.range(0, 100, 1, 9).selectExpr("array(id, id * id % 17, 3 * id) as x")
    total = whitening._summed(vectors, 3, 3, lambda x: x.astype(float).T @ x.astype(float))
    x = np.array([[k, k * k % 17, 3 * k] for k in range(100)], dtype=float)
    assert total.tolist() == (x.T @ x).tolist()
