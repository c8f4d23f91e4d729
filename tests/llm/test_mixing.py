from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rookery.llm.mixing import mix, mix_copies, source_targets


def plain_targets(held, weights=(5.0, 2.0, 1.0), limit=3.0):
    """Reshare the excess by weight until no source is above its limit."""
    names = sorted((s for s in held if s is not None)) + ([None] if None in held else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_names, left = dict.fromkeys(names, 0.0), set(names), float(sum(held.values()))
    while open_names:
        share = left / sum(weight[s] for s in open_names)
        full = {s for s in open_names if share * weight[s] > limit * held[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_names}
        target |= {s: limit * held[s] for s in full}
        left -= sum(limit * held[s] for s in full)
        open_names -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing(spark, seed):
    rng = random.Random(seed)
    held = {f"s{i:02}": rng.choice([0, 3, 50, 400, 10_000]) for i in range(rng.randrange(1, 12))} | {None: rng.randrange(60)}
    rows = spark.createDataFrame([(s, n) for s, n in held.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = plain_targets(held)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_shares_of_hot_and_odd_sources(spark, make_docs):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(0, 60), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    rows += [(i, "same size here", "en", "flat") for i in range(2000, 2400)]
    rows += [(None, "a b c", "en", None), (5000, None, "en", None), (5001, "", "en", "empty"), (7, rows[7][1], "en", rows[7][3])]
    docs = make_docs(rows).selectExpr("*", "1 as size", "2 as copies", "3 as _key", "4 as row")
    found = mix_copies(docs).collect()
    assert len(found) == len(rows)
    taken, target = {}, {}
    for r in found:
        assert 0 <= r.copies <= 3 and r.size == len((r.row.text or "").split())
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source] = r.target
    for source in target:
        assert abs(taken[source] - target[source]) <= 130, source
    again = {(r.row.doc_id, r.row.text): r.copies for r in mix_copies(docs.repartition(7)).collect()}
    assert all(again[r.row.doc_id, r.row.text] == r.copies for r in found if r.row.doc_id != 7)
    mixed = mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in found)
    assert mix(docs.filter(F.lit(False))).count() == 0
    assert mix(docs.filter("source = 'empty'")).count() == 0


def test_no_python_on_the_main_path(spark, make_docs):
    plan = mix(make_docs(["a b", "c"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
