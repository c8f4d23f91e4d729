"""Request planning, membership, de-duplication."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rookery.operators import archive, keys
from rookery.plans.ingest import plan_requests

BOARD = (
    '{"live_blitz":[{"username":"Ann"},{"username":"bob"}],"daily":[{"username":"ANN"}],'
    '"lessons":[],"_fetched_at":"2025-01-20T12:00:00"}'
)
JAN, FEB = dt.date(2025, 1, 1), dt.date(2025, 2, 1)


def test_leaderboard_players(spark):
    boards = spark.createDataFrame([(BOARD,)], "body string")
    assert {r.player for r in archive.leaderboard_players(boards).collect()} == {"ann", "bob"}


def test_plan_requests(spark):
    boards = spark.createDataFrame([(BOARD,)], "body string")
    landed = spark.createDataFrame([("player/ann/games/2025/01",)] * 3, "endpoint string")
    ledger = spark.createDataFrame([("bob", "2025/01", "failed")], "player string, period string, outcome string")

    def plan(**known):
        rows = plan_requests(boards, JAN, FEB, "https://x/pub/", **known).orderBy("endpoint").collect()
        return [r.endpoint for r in rows]

    assert plan(landed=landed) == [
        "player/ann/games/2025/02",
        "player/bob/games/2025/01",
        "player/bob/games/2025/02",
    ]
    assert plan(landed=landed, ledger=ledger) == ["player/ann/games/2025/02", "player/bob/games/2025/02"]
    assert len(plan(landed=landed, ledger=ledger, skip_failed=False)) == 3
    urls = plan_requests(boards, JAN, JAN, "https://x/pub/").orderBy("url").collect()
    assert urls[0].url == "https://x/pub/player/ann/games/2025/01"


def test_periods_that_are_no_months_are_not_done(spark):
    players = spark.createDataFrame([("ann",)], "player string")
    done = spark.createDataFrame(
        [("ann", p) for p in ("2024/12", "2025/01", "2025/01", "2025/0x", "2025/00", "2025/013", "2025/02", "2025/03", None)],
        "player string, period string",
    )
    for window in ((JAN, dt.date(2025, 3, 1)), (F.lit(JAN), F.lit(dt.date(2025, 3, 1)))):
        assert tuple(keys.coverage_counts(players, *window, done).first()) == (3, 3, 0)
    assert tuple(keys.coverage_counts(players, FEB, JAN, done).first()) == (0, 0, 0)
    assert keys.remaining_requests(players, FEB, JAN, done).collect() == []


def test_landed_periods(spark):
    paths = ["player/ann/games/2025/01", "x/player/b/games/2025/02/player/c/games/2025/03", "player/d/games/25/01", None]
    landed = spark.createDataFrame([(p,) for p in paths], "endpoint string")
    assert sorted(map(tuple, keys.landed_periods(landed).collect())) == [("ann", "2025/01"), ("b", "2025/02")]


def test_planning_reads_a_path_once_and_formats_no_month(spark):
    players = spark.createDataFrame([("ann",)], "player string")
    landed = spark.createDataFrame([("player/ann/games/2025/01",)], "endpoint string")
    plan = keys.remaining_requests(players, JAN, FEB, keys.landed_periods(landed))._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "date_format" not in text and "lambda" not in text
    assert text.count("regexp_extract") == 1


def test_coverage_adds_up(spark):
    players = spark.createDataFrame([("ann",), ("bob",)], "player string")
    landed = spark.createDataFrame(
        [(f"player/{p}/games/2025/01",) for p in ("ann", "ann", "eve")] + [("player/bob/games/2020/01",)], "endpoint string"
    )
    done = keys.landed_periods(landed)
    assert tuple(keys.coverage_counts(players, JAN, FEB, done).first()) == (4, 1, 3)
    todo = keys.remaining_requests(players, JAN, FEB, done)
    assert sorted(r.endpoint for r in todo.collect()) == [
        "player/ann/games/2025/02",
        "player/bob/games/2025/01",
        "player/bob/games/2025/02",
    ]
    assert tuple(keys.coverage_counts(players.limit(0), JAN, FEB, done).first()) == (0, 0, 0)


def test_requests_move_one_row_per_player(spark):
    players = spark.range(100).select(F.format_string("p%d", "id").alias("player"))
    done = spark.range(100).select(F.format_string("p%d", "id").alias("player"), F.lit("2025/01").alias("period"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keys.remaining_requests(players, JAN, dt.date(2025, 12, 1), done)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan.split("Generate explode")[0]
    assert "Exchange" in plan.split("Generate explode")[1]


def test_list_endpoints(spark):
    names = ["player/b/games/2025/04", "player/a/games/2025/04", "player/a/games/2025/03", "leaderboards/2025/04"]
    listed = keys.list_endpoints(spark.createDataFrame([(n,) for n in names], "path string"), "2025/04")
    assert [r.endpoint for r in listed.collect()] == ["player/a/games/2025/04", "player/b/games/2025/04"]


def test_set_difference_with_nulls(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(keys.set_difference(left, right).collect(), key=str) == [(1,), (None,)]
    assert keys.set_difference(left, right.union(left)).count() == 0


def test_modes(spark):
    endpoints = spark.createDataFrame([(f"e{i}",) for i in (3, 1, 2)], "endpoint string")
    assert [r[0] for r in keys.select_endpoints(endpoints, "TEST", 2).collect()] == ["e1", "e2"]
    assert [r[0] for r in keys.select_endpoints(endpoints, "DEV", dev_endpoint="e3").collect()] == ["e3"]
    assert keys.select_endpoints(endpoints, "PROD").count() == 3
    with pytest.raises(ValueError):
        keys.select_endpoints(endpoints, "OTHER")


def test_union_batches_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2, 0.5)], "name string, id int, extra double")
    rows = keys.union_batches([a, b]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, "y", 0.5)]


ROWS = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("abc"), st.integers(0, 3)), max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, known=st.lists(st.integers(0, 6), max_size=8))
def test_dedup_and_missing_match_brute_force(spark, rows, known):
    frame = spark.createDataFrame(rows, "game_id int, endpoint string, pos int")
    table = spark.createDataFrame([(k,) for k in known], "game_id int")
    first = {}
    for game, endpoint, pos in sorted(rows, key=lambda r: (r[1], r[2])):
        first.setdefault(game, (game, endpoint, pos))
    got = {tuple(r) for r in keys.keep_first(frame, "game_id", ["endpoint", "pos"]).collect()}
    assert got == set(first.values())

    missing = keys.missing_keys(frame, table, "game_id")
    assert {r[0] for r in missing.collect()} == set(first) - set(known)
    for kept in (keys.keep_missing(frame, missing, "game_id"), keys.rows_missing(frame, table, "game_id")):
        got = [tuple(r) for r in kept.select(frame.columns).collect()]
        assert sorted(got) == sorted(r for r in rows if r[0] not in known)

    filtered = sum(r[0] in known for r in rows)
    fresh = len(set(first) - set(known))
    want = (len(rows), filtered, len(rows) - filtered - fresh, fresh)
    assert tuple(keys.batch_counts(frame, table).first()) == want


def test_hot_key(spark):
    """A third of all rows share one id; the copies collapse before the shuffle."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, -1).otherwise(F.col("id")).alias("game_id"),
        F.format_string("e%05d", F.lit(30_000) - F.col("id")).alias("endpoint"),
        F.lit(0).alias("pos"),
    )
    first = keys.keep_first(rows, "game_id", ["endpoint", "pos"])
    assert first.count() == 20_001
    assert first.where("game_id = -1").first().endpoint == "e20001"
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan.split("Exchange", 1)[1]


def test_grid_has_no_join(spark):
    players = spark.createDataFrame([("ann",), ("bob",)], "player string")
    grid = keys.request_grid(players, JAN, dt.date(2025, 12, 1))
    want = {(p, f"2025/{m:02d}") for p, m in itertools.product(("ann", "bob"), range(1, 13))}
    assert {(r.player, r.period) for r in grid.collect()} == want
    assert "Join" not in grid._jdf.queryExecution().executedPlan().toString()
