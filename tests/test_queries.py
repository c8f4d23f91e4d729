"""Every registered query: equal to its SQL, without cross joins or Python workers."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from rookery import bindings

SF_DIR = "/root/testdata/sf0.001"
# A minimum that the smallest tables don't reach.
LARGER = {"min_games_having": "/root/testdata/sf0.01"}
QUERIES = bindings.queries()
ORACLE = bindings.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key):
    sf_dir = LARGER.get(key, SF_DIR)
    con = connect(sf_dir) if key in LARGER else con
    frame = QUERIES[key](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan
    assert compare(frame, con, ORACLE[key]) is None


def test_entry(spark):
    assert 0 < entry.entry(spark).count() <= 10
