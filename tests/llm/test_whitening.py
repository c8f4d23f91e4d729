from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rookery.llm import whitening
from rookery.llm.queries import QUERIES
from rookery.llm.spectral import leading_components, polar_factor


def matrices():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 24):
        full = rng.normal(size=(n, n))
        thin = rng.normal(size=(n, max(1, n // 3)))
        yield full @ full.T
        yield full + full.T
        yield thin @ thin.T
        yield np.eye(n) * 5.0
        yield np.zeros((n, n))
        yield np.diag([1.0] * (n // 2) + [0.0] * (n - n // 2))
        yield np.diag(np.arange(n) // 2 * 1.0)


def test_components_equal_a_dense_solver():
    for matrix in matrices():
        n, scale = len(matrix), np.linalg.norm(matrix) + 1e-300
        for k in (1, 4, n):
            values, axes = leading_components(matrix, k)
            assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], atol=1e-13 * scale * n, rtol=0)
            assert np.allclose(axes.T @ axes, np.eye(min(k, n)), atol=1e-13)
            assert np.linalg.norm(matrix @ axes - axes * values) <= 1e-13 * scale * n


def test_polar_factor():
    rng = np.random.default_rng(5)
    for n in (1, 4, 30):
        matrix = rng.normal(size=(n, n))
        left, _, right = np.linalg.svd(matrix)
        assert np.allclose(polar_factor(matrix), left @ right, atol=1e-11)


def plain(rows, k=4):
    """(vec_id, vector) rows -> n and {(vec_id, component): (deviation, |whitened|, explained)} with sorted multiples."""
    held = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    dims = max((len(v) for _, v in held), default=0)
    held = [(i, v + [0] * (dims - len(v))) for i, v in held]
    distinct = sorted({tuple(v) for _, v in held})
    n = len(distinct)
    if not n or not dims:
        return []
    sums = [sum(c) for c in zip(*distinct)]
    centred = np.array(distinct, float) - np.array(sums) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    out = []
    for i, v in held:
        deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums))
        for c in range(len(values)):
            varies = values[c] > 1e-9
            white = abs((np.array(v) - np.array(sums) / n) @ axes[:, c] / math.sqrt(values[c])) if varies else None
            trace = np.trace(covariance)
            out.append((i, c + 1, n, deviation, white, values[c] * varies / trace if trace else None))
    return out


def run(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    # Names of the result, and names that are no plain identifiers.
    frame = frame.selectExpr("*", "1 as n", "2 as component", "3 as `a b`", "4 as `a.b`", "5 as `x`")
    return whitening.whiten(frame).collect()


def key(row):
    return (row[0] is None, row[0] or 0, row[1], row[3] or 0)


def same(found, expected):
    assert len(found) == len(expected)
    for f, e in zip(sorted(found, key=key), sorted(expected, key=key)):
        assert tuple(f[:4]) == tuple(e[:4])
        assert (f.whitened is None) == (e[4] is None)
        assert e[4] is None or abs(f.whitened) == pytest.approx(e[4], abs=1e-8)
        assert f.explained == (None if e[5] is None else pytest.approx(e[5], abs=1e-12))


def vectors(n=300, dims=9):
    rng = np.random.default_rng(8)
    mix = rng.normal(size=(dims, dims)) * np.geomspace(3, 0.1, dims)
    return [(i, (rng.normal(size=dims) @ mix + 1).tolist()) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors()
    # A third of all rows are copies of one vector; some rows take no part; ids repeat and are null.
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(7, rows[3][1]), (None, rows[4][1]), (None, None)]
    rows += [(2000, None), (2001, [1.0] * 8 + [None]), (2002, [float("nan")] * 9), (2003, [float("-inf")] + [0.0] * 8)]
    rows += [(2004, [0.5] * 4), (2005, []), (2006, [-0.0] * 9)]
    found = run(spark, rows)
    same(found, plain(rows))
    assert {f.identity_error for f in found} and max(f.identity_error for f in found) < 1e-9
    assert len({f.identity_error for f in found}) == 1


def test_signs_agree_over_rows(spark):
    rows = vectors(120)
    found = {(f.vec_id, f.component): f.whitened for f in run(spark, rows)}
    x = np.floor(256 * np.array([np.float32(v) for _, v in rows], float))
    centred = x - x.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    for c in range(4):
        expected = centred @ axes[:, -1 - c] / np.sqrt(values[-1 - c])
        got = np.array([found[i, c + 1] for i, _ in rows])
        assert min(abs(got - expected).max(), abs(got + expected).max()) < 1e-8


def test_without_variance(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, [(1, []), (2, [])]) == []
    (one,) = run(spark, [(1, [0.5])])
    assert tuple(one) == (1, 1, 1, 0, None, None, None)
    same(run(spark, [(i, [0.5, 0.25, 0.125]) for i in range(40)]), plain([(i, [0.5, 0.25, 0.125]) for i in range(40)]))
    flat = [(i, [i / 8, i / 4, 0.0]) for i in range(20)]
    found = run(spark, flat)
    same(found, plain(flat))
    assert {f.whitened is None for f in found if f.component > 1} == {True} and found[0].identity_error < 1e-9


def test_deviation_stays_exact(spark):
    big = [(0, [1e6, 0.0]), (1, [-1e6, 1.0]), (2, [3.0, 2e5])]
    same(run(spark, big, "double"), plain(big))
    wide = whitening.deviations(np.array([[2**40, 0], [1, 2]]), 2**20, (0, 2**62))
    assert wide == [None, None] and whitening.deviations(np.array([[3, 1]]), 2, (1, 1)) == [26]
    assert whitening.deviations(np.array([[2**45, 0]]), 2**19, (2**64, 0)) == [0]


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op13_embedding_whitening"](spark, sf_dir)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    same(found.collect(), plain(rows))
    assert found.agg(F.countDistinct("identity_error")).first()[0] == 1
