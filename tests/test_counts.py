"""Windowed stream counts: state, late rows, repeated runs."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rookery.streaming import counts
from rookery.streaming.runs import file_stream

MONDAY = dt.datetime(2025, 1, 6)
SCHEMA = (
    "game_id int, end_dt timestamp, time_class string, opening string, "
    "white struct<result string>, black struct<result string>"
)
ROWS = [
    (i, MONDAY + dt.timedelta(days=i % 30, hours=i % 24), "blitz" if i % 3 else None, "AB"[i % 2], ("win",), ("x",))
    for i in range(180)
]


def week(when):
    return (when - dt.timedelta(days=when.weekday())).date()


def plain(rows):
    held = Counter((week(r[1]), r[2], r[3]) for r in rows)
    return {(*key, n, n, 0) for key, n in held.items()}


def run(spark, folder, parts, delay="2 days", max_files=None):
    """Land and count the parts one after the other; the store and the finished queries."""
    source, store = f"{folder}/in", counts.CountStore(f"{folder}/counts")
    runs = []
    for part in parts:
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(source)
        stream = file_stream(spark, source, spark.read.schema(SCHEMA).parquet(source).schema, max_files=max_files)
        runs.append(counts.run_counts(stream, counts.WEEKLY_GAMES, store, delay))
    return store, runs


def rows_of(frame):
    return {tuple(r) for r in frame.collect()}


def weeks():
    found = {}
    for row in ROWS:
        found.setdefault(week(row[1]), []).append(row)
    return [found[k] for k in sorted(found)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_all_windows_in_any_order(spark, tmp_path, order):
    parts = [ROWS[0::3], ROWS[1::3], ROWS[2::3]]
    parts = [sorted(p, key=lambda r: r[1]) for p in parts]
    store, runs = run(spark, tmp_path, [parts[i] for i in order], max_files=1)
    assert rows_of(counts.so_far(spark, counts.WEEKLY_GAMES, store)) == plain(ROWS)
    assert rows_of(counts.WEEKLY_GAMES.batch(spark.createDataFrame(ROWS, SCHEMA))) == plain(ROWS)


def test_newest_week_first(spark, tmp_path):
    """Every later run is late for closed windows: nothing reaches the state, nothing is lost."""
    store, runs = run(spark, tmp_path, weeks()[::-1])
    assert rows_of(counts.so_far(spark, counts.WEEKLY_GAMES, store)) == plain(ROWS)
    assert spark.read.parquet(store.corrections).agg(F.sum("total_games")).first()[0] > 100
    dropped = [o["numRowsDroppedByWatermark"] for r in runs for p in r.recentProgress for o in p["stateOperators"]]
    assert sum(dropped) == 0


def test_state_holds_open_windows_only(spark, tmp_path):
    store, runs = run(spark, tmp_path, weeks(), "1 day")
    held = [r.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] for r in runs]
    # Four groups a week; a week closes a day after the next has begun.
    assert len(held) == 5 and max(held) <= 8
    assert rows_of(counts.delivered(spark, counts.WEEKLY_GAMES, store)) == plain([r for w in weeks()[:4] for r in w])
    assert rows_of(counts.open_windows(spark, counts.WEEKLY_GAMES, store)) == plain(weeks()[4])
    until = counts.boundary(spark, store)
    assert until == max(r[1] for r in ROWS) - dt.timedelta(days=1)


def test_run_without_new_rows_adds_nothing(spark, tmp_path):
    store, _ = run(spark, tmp_path, weeks()[:2])
    before = rows_of(counts.so_far(spark, counts.WEEKLY_GAMES, store))
    stream = file_stream(spark, f"{tmp_path}/in", spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in").schema)
    counts.run_counts(stream, counts.WEEKLY_GAMES, store, "2 days")
    assert rows_of(counts.so_far(spark, counts.WEEKLY_GAMES, store)) == before


@pytest.mark.parametrize("stop", ["before the boundary", "before the totals"])
def test_a_run_that_stops_is_made_good_by_the_next(spark, tmp_path, monkeypatch, stop):
    first, second = weeks()[:2], weeks()[2:]
    store, _ = run(spark, tmp_path, first)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):

        def fail(*_):
            raise RuntimeError(stop)

        patch.setattr(counts, "partial_schema" if stop == "before the boundary" else "_start_totals", fail)
        run(spark, tmp_path, [second[2]])
    store, _ = run(spark, tmp_path, [second[0], second[1]])
    assert rows_of(counts.so_far(spark, counts.WEEKLY_GAMES, store)) == plain(ROWS)


def test_a_replayed_batch_counts_once(spark, tmp_path):
    store, _ = run(spark, tmp_path, weeks()[:1])
    rows = spark.createDataFrame(weeks()[1], SCHEMA)
    for _ in range(2):
        # The number of a batch that was not confirmed comes again.
        counted = counts.WEEKLY_GAMES.partial(rows)
        counted.write.mode("overwrite").parquet(f"{store.corrections}/batch=7")
    assert rows_of(counts.so_far(spark, counts.WEEKLY_GAMES, store)) == plain(weeks()[0] + weeks()[1])


def test_rows_without_time_lie_in_no_window(spark, tmp_path):
    rows = weeks()[0][:5] + [(999, None, "blitz", "A", ("win",), ("x",))]
    store, _ = run(spark, tmp_path, [rows])
    assert rows_of(counts.so_far(spark, counts.WEEKLY_GAMES, store)) == plain(rows[:5])
