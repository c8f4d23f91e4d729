from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rookery.llm import neighbours
from rookery.llm.queries import QUERIES


def taking_part(rows):
    return [
        (i, [float(np.float32(c)) for c in v])
        for i, v in rows
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ]


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def plain(rows, k):
    """(vec_id, vector) rows -> sorted (query_id, rank, vec_id, score)."""
    held = taking_part(rows)
    out = []
    for a, (i, q) in enumerate(held):
        if i % 20 == 0:
            scored = sorted((-product(q, c), j) for b, (j, c) in enumerate(held) if b != a)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=20, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    frame = frame.selectExpr("*", "1 as score", "2 as rank", "3 as vec", "4 as k1", "5 as `a.b`", "6 as `a b`")
    found = neighbours.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, k)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


def recall(found, expected):
    """Share of true neighbours found, one counting as found if its score is."""
    least = {}
    for i, _, _, s in expected:
        least[i] = min(s, least.get(i, math.inf))
    return sum(s >= least[i] for i, _, _, s in found) / len(expected)


def clustered(n=3000, dims=24, seed=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dims))
    x = centres[rng.integers(0, 30, n)] + 0.7 * rng.normal(size=(n, dims))
    return [(i, v) for i, v in enumerate((x * rng.uniform(0.5, 2, (n, 1))).tolist())]


@pytest.mark.parametrize("numbers", [1 << 18, 3000])
def test_recall_and_exact_scores(spark, monkeypatch, numbers):
    monkeypatch.setattr(neighbours, "CHUNK_NUMBERS", numbers)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    monkeypatch.setattr(neighbours, "STEP_ROWS", 50)
    rows = clustered()
    found, expected = run(spark, rows), plain(rows, 20)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert recall(found, expected) >= 0.93
    vectors = dict(taking_part(rows))
    for i, _, j, score in found:
        assert i != j and score == product(vectors[i], vectors[j])
    for (i, n, a, s), (j, _, b, t) in zip(found, found[1:]):
        assert i != j or s > t or (s == t and a < b)


def test_copies_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK_NUMBERS", 900)
    rows = clustered(300, 8)
    # A third of all rows are copies of one vector; ids repeat.
    rows += [(1000 + i, rows[20][1]) for i in range(150)] + [(40, rows[20][1]), (40, rows[7][1]), (7, rows[40][1])]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, []), (None, rows[3][1]), (2060, [1.0] * 7 + [None])]
    rows += [(2080, [float("nan")] * 8), (2100, [float("inf")] + [1.0] * 7), (2120, [0.5] * 3), (2121, [-0.0] * 8)]
    found, expected = run(spark, rows), plain(rows, 20)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert recall(found, expected) >= 0.9
    hot = {i for i in range(1000, 1150) if i % 20 == 0}
    assert [r for r in found if r[0] in hot] == [r for r in expected if r[0] in hot]
    assert max(r[2] for r in found if r[0] == 1040 and r[3] == max(s for i, _, _, s in found if i == 1040)) <= 1021


def test_few_rows_are_all_found(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert run(spark, [(0, None), (1, [0.0])]) == []
    for n in (2, 3, 15, 22):
        rows = [(i, v) for i, v in clustered(n, 5)]
        assert run(spark, rows) == plain(rows, 20)
    same = [(i, [0.25, -0.5]) for i in range(130)]
    assert run(spark, same, 3) == plain(same, 3)


def test_far_apart_lengths(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate((rng.normal(size=(400, 6)) * rng.choice([1e-3, 1.0, 50.0], (400, 1))).tolist())]
    found, expected = run(spark, rows), plain(rows, 20)
    assert [r[:2] for r in found] == [r[:2] for r in expected] and recall(found, expected) >= 0.9
    tall = [(i, [c * 1e150 for c in v]) for i, v in clustered(60, 4)]
    found = run(spark, tall, 5, "double")
    assert {r[0] for r in found} == {0, 20, 40} and len(found) == 15


def test_scan_without_score_to_beat_keeps_all():
    rng = np.random.default_rng(0)
    q, c = (rng.normal(size=(n, 40)).astype(np.float32) for n in (5, 9))
    q, c = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (q, c))
    at_q, at_c, value = neighbours.adaptive_scan(q, np.ascontiguousarray(c.T), np.full(5, -np.inf))
    assert len(at_q) == 45 and np.allclose(value, (q @ c.T)[at_q, at_c], atol=1e-5)
    at_q, at_c, _ = neighbours.adaptive_scan(q, np.ascontiguousarray(c.T), np.sort(q @ c.T, axis=1)[:, -2])
    assert set(zip(at_q.tolist(), at_c.tolist())) <= {(i, j) for i in range(5) for j in np.argsort(-(q @ c[:, :].T)[i])[:9]}
    assert np.bincount(at_q, minlength=5).min() >= 1


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = QUERIES["op11_nearest_neighbours"](spark, sf_dir).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
    expected = plain(rows, 20)
    assert [r[:2] for r in found] == [r[:2] for r in expected] and recall(found, expected) >= 0.93
