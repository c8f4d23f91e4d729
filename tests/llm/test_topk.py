from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rookery.llm import topk


def plain(rows, k):
    """(vec_id, vector) rows -> sorted (query_id, rank, vec_id, score)."""
    held = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, q) in enumerate(held):
        if i % 50 == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(q, c)), j) for b, (j, c) in enumerate(held) if b != a
            )[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as rank")
    found = topk.top_inner_products(frame, F.col("vec_id") % 50 == 0, k)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


@pytest.mark.parametrize("numbers", [1 << 18, 96])
def test_equals_brute_force(spark, monkeypatch, numbers):
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", numbers)
    monkeypatch.setattr(topk, "QUERY_NUMBERS", numbers)
    monkeypatch.setattr(topk, "STEP_ROWS", 7)
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(12, 12)) * np.geomspace(2, 0.02, 12)
    rows = [(i, (rng.normal(size=12) @ mix * rng.choice([0.1, 1, 3])).tolist()) for i in range(420)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(40)]
    rows += [(1000, [0.0] * 12), (50, rows[3][1]), (None, rows[0][1]), (2000, None), (2050, [0.5] * 5), (2051, [])]
    rows += [(2100, [1.0] * 11 + [None]), (2150, [float("nan")] * 12), (2200, [float("inf")] + [0.0] * 11)]
    assert run(spark, rows) == plain(rows, 5)


def test_few_rows(spark):
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    rows = [(0, [1.0, 2.0]), (1, [-1.0, 0.0]), (2, [-1.0, 0.0])]
    assert run(spark, rows) == plain(rows, 5) == [(0, 1, 1, -65536), (0, 2, 2, -65536)]


def test_all_equal(spark):
    rows = [(i, [0.25, -0.5]) for i in range(130)]
    assert run(spark, rows, 3) == plain(rows, 3)


def test_short_blocks_are_not_sent(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 40)
    rng = np.random.default_rng(1)
    rows = [(i + 1, (rng.normal(size=4) * (100 if i < 40 else 0.01)).tolist()) for i in range(400)] + [(0, [1.0, 1.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_inner_products(frame, F.col("vec_id") == 0).collect())) == [
        r for r in plain(rows, 5) if r[0] == 0
    ]


def test_scores_are_carried_from_block_to_block(monkeypatch):
    rng = np.random.default_rng(3)
    dims, k = 6, 2
    queries = rng.integers(-50, 50, (8, dims))
    blocks = [(rng.normal(size=(30, dims)) * scale).astype(np.int64) for scale in (400, 300, 60, 5, 1, 1)]

    def packed(uids, values):
        return uids.astype(np.int64).tobytes() * 2 + values.astype(np.int64).tobytes()

    start, rows = 100, []
    for block in blocks:
        rows.append(
            {
                "q_block": 0, "q_n": len(queries), "q_data": packed(np.arange(8), queries),
                "beat": np.full(8, np.iinfo(np.int64).min).tobytes(),
                "length": float(np.sqrt((block.astype(float) ** 2).sum(1)).max()), "n": 30,
                "data": packed(np.arange(start, start + 30), block),
            }
        )
        start += 30
    kinds = pa.schema(
        [("q_block", pa.int64()), ("q_n", pa.int32()), ("q_data", pa.binary()), ("beat", pa.binary()),
         ("length", pa.float64()), ("n", pa.int32()), ("data", pa.binary())]
    )
    met = []
    top = topk.block_top
    monkeypatch.setattr(topk, "block_top", lambda q, c, *rest: met.append(len(q[0])) or top(q, c, *rest))
    batches = [pa.RecordBatch.from_pylist([row], kinds) for row in rows]
    found = pa.Table.from_batches(list(topk.search_blocks(batches, dims, np.eye(dims), k))).to_pylist()
    # The short blocks can't reach what the long ones gave.
    assert met[0] == 8 and sum(met) < 8 * 4 and len(met) < len(blocks)
    everything = np.concatenate(blocks)
    for uid, query in enumerate(queries):
        best = sorted((r["score"] for r in found if r["query_uid"] == uid), reverse=True)[:k]
        assert best == sorted((everything @ query).tolist(), reverse=True)[:k]
