"""Whitening against numpy's eigenvalues and against whole-number arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from gridpanel.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>"


def numbers(rows):
    """(ids, x as Python integers) of the rows that take part."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) <= 2**47 for c in v)]
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = [(i, v) for i, v in good if len(v) == d]
    return [i for i, _ in good], [[math.floor(64 * c) + 1_000_000 for c in map(float, np.array(v, np.float32))] for _, v in good]


def check(spark, rows, most=32, tolerance=1e-7):
    ids, x = numbers(rows)
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    deviation = sorted((i is not None, i or 0, sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)))
                       for i, r in zip(ids, x, strict=True))
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums, strict=True)] for r in x])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    rank = min(most, int((value > d * 1e-13 * value[0]).sum()))
    out = W.whiten(spark.createDataFrame(rows, SCHEMA), most).collect()
    assert len(out) == n * rank
    assert {r.component for r in out} == set(range(1, rank + 1))
    by = {}
    for r in out:
        by.setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error <= 1e-4 and r.identity_error == out[0].identity_error
        assert r.explained == pytest.approx(value[r.component - 1] / value.sum(), rel=1e-6)
    assert sorted((r.vec_id is not None, r.vec_id or 0, int(r.deviation)) for r in by[1]) == deviation
    for k in range(rank):
        if min(abs(value[k] - value[j]) for j in (k - 1, k + 1) if 0 <= j < d) < 1e-6 * value[0]:
            continue        # a tie: any direction of the plane will do
        want = sorted(np.round(centred @ vector[:, k] / math.sqrt(value[k]), 6).tolist())
        got = sorted(r.whitened for r in by[k + 1])
        flipped = sorted(-g for g in got)
        assert np.allclose(got, want, atol=2e-6) or np.allclose(flipped, want, atol=2e-6)


def test_against_numpy(spark):
    g = np.random.default_rng(5)
    x = g.normal(size=(400, 40)) @ g.normal(size=(40, 40)) * 0.1
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (900, None), (901, []), (902, [1.0] * 39 + [None]),
             (903, [float("nan")] * 40), (904, [float("inf")] + [0.0] * 39), (905, [1.0, 2.0]), (906, [3e38] * 40)]
    check(spark, rows)


def test_a_hot_vector_and_rank_below_dimensions(spark):
    g = np.random.default_rng(6)
    x = np.repeat(g.normal(size=(120, 3)).round(2), 3, axis=1)     # rank 3 in 9 dimensions
    x = np.concatenate((x, np.repeat(x[:1], 60, axis=0)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    check(spark, rows)
    check(spark, rows, most=2)


def test_large_entries_are_exact(spark):
    g = np.random.default_rng(8)
    check(spark, [(i, (v * 10.0 ** 9).tolist()) for i, v in enumerate(g.normal(size=(50, 4)).astype(np.float32))])


def test_no_variance_and_empty_table(spark):
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []
    empty = W.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[-1] == "identity_error"


def test_clashing_columns(spark):
    rows = [(i, [float(i), float(i * i % 7)], "a", 1) for i in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA + ", id string, component int")
    assert W.whiten(frame).count() == 60


def test_factors():
    g = np.random.default_rng(3)
    for d, rank in ((1, 1), (7, 4), (30, 30), (31, 12)):
        a = g.normal(size=(d, rank)) * np.logspace(0, -4, rank)
        v = a @ a.T
        low = W.pivoted_cholesky(v)
        assert low.shape == (d, rank) and np.allclose(low @ low.T, v, atol=1e-12)
        value, component = W.one_sided_jacobi(low)
        assert np.allclose(component.T @ component, np.eye(rank), atol=1e-12)
        assert np.allclose(value, np.linalg.svd(a, compute_uv=False) ** 2, rtol=1e-7)
