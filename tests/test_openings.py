"""Opening statistics: fixture cases of FIXTURES.md."""

from __future__ import annotations

import datetime as dt
import math
import statistics
import uuid

import pytest
from pyspark.sql import functions as F

from rookery import schemas
from rookery.operators import openings as ops
from rookery.plans.reports import opening_report
from rookery.session import scratch_path
from rookery.sources import tables

W1, W2 = dt.date(2025, 1, 6), dt.date(2025, 1, 13)
ROWS = [
    (W1, "blitz", "Sicilian", 10, 5, 4),
    (W1, "rapid", "Sicilian", 6, 3, 3),
    (W2, "blitz", "Sicilian", 4, 1, 1),
    (W1, "blitz", "French", 20, 8, 10),
    (W1, None, "French", 2, None, None),
    (W1, "blitz", None, 7, 1, 2),
    (W2, "blitz", "Unplayed", 0, 0, 0),
    (W2, "rapid", "English", 22, 2, 1),
]


@pytest.fixture
def weekly(spark):
    return spark.createDataFrame(ROWS, schemas.readable(schemas.WEEKLY_OPENINGS))


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*order).collect()]


def test_aggregates_drop_null_keys_and_sum_null_as_zero(weekly):
    got = {r[0]: r[1:4] for r in rows(ops.by_opening(weekly), "opening_archetype")}
    assert got == {"Sicilian": (20, 9, 8), "French": (22, 8, 10), "Unplayed": (0, 0, 0), "English": (22, 2, 1)}
    keyed = rows(ops.timeclass_opening(weekly), "time_class", "opening_archetype")
    assert [r[:3] for r in keyed] == [
        ("blitz", "French", 20),
        ("blitz", "Sicilian", 14),
        ("blitz", "Unplayed", 0),
        ("rapid", "English", 22),
        ("rapid", "Sicilian", 6),
    ]


def test_zero_games_have_no_rate(weekly):
    unplayed = ops.by_opening(weekly).where("opening_archetype = 'Unplayed'").first()
    assert unplayed.white_win_pct is None and unplayed.black_win_pct is None


def test_minimum_is_strict_and_per_grain(weekly):
    assert {r[0] for r in rows(ops.by_opening(weekly, 20), "opening_archetype")} == {"French", "English"}
    assert ops.by_opening(weekly, 19).count() == 3
    # 20 games in total, but never more than 16 in a week.
    per_week = ops.weekly_opening(weekly, 16)
    assert {r[1] for r in rows(per_week, "week_start")} == {"French", "English"}
    assert rows(ops.weekly_totals(per_week), "week_start") == [(W1, 22), (W2, 22)]


def test_weekly_totals_match_weekly_openings(weekly):
    base = ops.weekly_opening(weekly)
    assert base.agg(F.sum("total_games")).first() == ops.weekly_totals(base).agg(F.sum("total_games")).first()


@pytest.mark.parametrize(
    ("chosen", "n"), [("all", 8), (None, 8), ([], 8), ("rapid", 2), (["rapid"], 2), (["rapid", "blitz"], 7)]
)
def test_time_class_choice(weekly, chosen, n):
    assert ops.dimension_filter(weekly, chosen).count() == n


def test_opening_choice_and_weeks(weekly):
    assert ops.dimension_filter(weekly, "blitz", ["Sicilian", "English"]).count() == 2
    assert ops.week_range(weekly, W1, W1).count() == 5
    assert ops.week_range(weekly, "2025-01-06", "2025-01-13").count() == 8


def test_kpis(weekly):
    got = {r.kpi: (r.opening, r.value) for r in ops.opening_kpis(ops.by_opening(weekly)).collect()}
    assert got == {
        # English and French tie at 22 games.
        "most_played_opening": ("English", 22.0),
        "least_played_opening": ("Unplayed", 0.0),
        "highest_win_pct_as_white": ("Sicilian", 45.0),
        "highest_win_pct_as_black": ("French", 10 / 22 * 100),
        "lowest_win_pct_as_white": ("English", 2 / 22 * 100),
        "lowest_win_pct_as_black": ("English", 1 / 22 * 100),
    }
    assert ops.opening_kpis(ops.by_opening(weekly.where("false"))).count() == 0


def test_top_openings(weekly):
    assert [r.opening_archetype for r in ops.top_openings(ops.by_opening(weekly), 3).collect()] == [
        "English",
        "French",
        "Sicilian",
    ]


def test_hierarchy(weekly):
    default = rows(ops.opening_hierarchy(weekly), F.col("parent").asc_nulls_first(), "node")
    assert default[0] == ("All", None, 64)
    assert ("Undefined", "All", 7) not in default
    full = rows(ops.opening_hierarchy(weekly, include_undefined=True), F.col("parent").asc_nulls_first(), "node")
    assert full[0] == ("All", None, 71) and ("Undefined", "All", 7) in full


def test_distribution(weekly):
    counts = ops.by_opening(weekly)
    values = [r.white_win_pct for r in counts.collect() if r.white_win_pct is not None]
    stats = ops.win_pct_stats(counts).first()
    assert stats.n_openings == 3
    assert math.isclose(stats.mean_pct, statistics.mean(values))
    assert math.isclose(stats.std_pct, statistics.stdev(values))
    bins = ops.win_pct_histogram(counts).collect()
    assert sum(b.n_openings for b in bins) == 3
    assert math.isclose(sum(b.density * (b.bin_end - b.bin_start) for b in bins), 1.0)
    # The maximum belongs to the last bin.
    assert {b.bin for b in bins} <= set(range(1, 11)) and 10 in {b.bin for b in bins}
    curve = rows(ops.normal_curve(counts), "point")
    assert len(curve) == 200
    normal = statistics.NormalDist(stats.mean_pct, stats.std_pct)
    for _, x, density in (curve[0], curve[77], curve[199]):
        assert math.isclose(density, normal.pdf(x), rel_tol=1e-9)
    assert math.isclose(curve[0][1], min(values)) and math.isclose(curve[199][1], max(values))


def test_single_value_distribution(weekly):
    counts = ops.by_opening(weekly.where("opening_archetype = 'French'"))
    (only,) = ops.win_pct_histogram(counts).collect()
    assert (only.bin, only.n_openings) == (1, 1) and only.bin_start == only.bin_end
    assert ops.win_pct_stats(counts).first().std_pct is None


def test_pivot_and_points(weekly):
    pivot = ops.win_pct_pivot(ops.timeclass_opening(weekly), ["blitz", "rapid"])
    got = {r.opening_archetype: (r.blitz, r.rapid) for r in pivot.collect()}
    assert got["Sicilian"] == (6 / 14 * 100, 50.0)
    assert got["English"] == (None, 2 / 22 * 100)
    points = ops.win_rate_points(ops.by_opening(weekly), "black")
    assert {r.opening_archetype: r.win_pct for r in points.collect()}["Sicilian"] == 40.0
    assert points.count() == 3
    with pytest.raises(ValueError):
        ops.win_rate_points(ops.by_opening(weekly), "red")


def test_dimensions(weekly):
    dims = ops.distinct_dimensions(weekly, ["time_class", "opening_archetype"], with_all=["time_class"])
    got = rows(dims, "dimension", "sort_rank", "value")
    assert [r[2] for r in got if r[0] == "time_class"] == ["all", "blitz", "rapid"]
    assert [r[2] for r in got if r[0] == "opening_archetype"] == ["English", "French", "Sicilian", "Unplayed"]


def test_build(spark):
    day = dt.date(2025, 1, 12)  # a Sunday
    games = spark.createDataFrame(
        [(day, "blitz", "A", ("win",), ("x",)), (day, "blitz", "B", ("x",), ("win",)), (day, "blitz", "Z", ("x",), ("x",))],
        "game_date date, time_class string, opening string, white struct<result string>, black struct<result string>",
    )
    mapping = spark.createDataFrame([("A", "Fam"), ("B", "Fam"), ("B", "Fam")], "opening string, opening_archetype string")
    got = rows(ops.build_weekly_openings(games, mapping), F.col("opening_archetype").asc_nulls_first())
    assert got == [(W1, "blitz", None, 1, 0, 0), (W1, "blitz", "Fam", 2, 1, 1)]
    sunday = ops.build_weekly_openings(games, week_offset_days=-1).first()
    assert sunday.week_start == day


def test_report(weekly):
    with opening_report(weekly, W1, W2, "all", None, 10, "white") as report:
        assert [r.opening_archetype for r in report["top"].collect()] == ["English", "French", "Sicilian"]
        assert rows(report["weekly_totals"], "week_start") == [(W1, 38), (W2, 22)]
        assert report["hierarchy"].where("parent IS NULL").first().total_games == 64
        assert report["kpis"].count() == 6
        assert report["points"].count() == 3
        assert sum(b.n_openings for b in report["histogram"].collect()) == 3
        assert report["curve"].count() == 200
        assert report["weekly_opening"].count() == 3
        assert report["timeclass_opening"].count() == 3
        assert report["stats"].first().n_openings == 3


def test_week_range_reaches_the_scan(spark):
    from rookery.bindings.views import weekly

    ranged = weekly(spark, "/root/testdata/sf0.001", "1996-01-01", "1996-03-31")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in plan and "LessThan(l_shipdate,1996" in plan
    whole = ops.week_range(weekly(spark, "/root/testdata/sf0.001"), "1996-01-01", "1996-03-31")
    assert sorted(map(str, ranged.collect())) == sorted(map(str, whole.collect()))


def test_one_expansion_gives_all_aggregates(spark, weekly):
    grouped = ops.grouped_counts(weekly)
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange") == 1
    for keys, plain in (
        (["week_start", "opening_archetype"], ops.weekly_opening),
        (["time_class", "opening_archetype"], ops.timeclass_opening),
        (["opening_archetype"], ops.by_opening),
    ):
        for minimum in (None, 10):
            got = ops.at_level(grouped, keys, minimum, with_pct=plain is not ops.weekly_opening)
            want = plain(weekly, minimum)
            assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_report_reads_its_base_once(spark, weekly):
    with opening_report(weekly, W1, W2, "all", None, None, "white") as report:
        for name in set(report) - {"dimensions"}:
            plan = report[name]._jdf.queryExecution().executedPlan().toString()
            # Only the staged aggregates are read; the hierarchy has a roll-up of its own.
            assert "opening-report" in plan and ("Expand" in plan) == (name == "hierarchy")
        assert {r.value for r in report["dimensions"].where("dimension = 'time_class'").collect()} == {"all", "blitz", "rapid"}
        assert sorted(report["heat_map"].columns) == ["blitz", "opening_archetype", "rapid"]


def test_refresh_keeps_the_weeks_a_load_does_not_touch(spark):
    from rookery.plans.weekly import create_weekly_openings, refresh_weekly_openings

    name = f"t_{uuid.uuid4().hex}"
    tables.ensure_database(spark, name, scratch_path(spark, name))
    create_weekly_openings(spark, f"{name}.weekly")
    schema = "game_date date, time_class string, opening string, white struct<result string>, black struct<result string>"
    first = [(W1 + dt.timedelta(days=i), "blitz", "A", ("win",), ("x",)) for i in range(14)]
    later = [(W1 + dt.timedelta(days=20), "blitz", "A", ("x",), ("win",))]
    refresh_weekly_openings(spark.createDataFrame(first, schema), spark.createDataFrame(first, schema), f"{name}.weekly")
    refresh_weekly_openings(spark.createDataFrame(first + later, schema), spark.createDataFrame(later, schema), f"{name}.weekly")
    weeks = {r.week_start: r.total_games for r in tables.current(spark, f"{name}.weekly").collect()}
    assert weeks == {W1: 7, W1 + dt.timedelta(days=7): 7, W1 + dt.timedelta(days=14): 1}
    spark.sql(f"DROP DATABASE {name} CASCADE")
