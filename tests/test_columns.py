"""Column functions: fixture cases of FIXTURES.md."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rookery.functions import games, jobs, labels, paths, periods

D = dt.date


def day(y, m, d):
    return F.lit(D(y, m, d))


@pytest.mark.parametrize(
    ("url", "last"), [("https://x/game/live/101", "101"), ("https://x/a/", ""), ("plain", "plain"), ("", "")]
)
def test_last_component(one, url, last):
    assert one(paths.last_component(F.lit(url))) == last


def test_eco_chain(one):
    tag = '[Event "x"]\n[ECOUrl "https://x/openings/Kings-Gambit"]\n\n1. e4'
    null = F.lit(None).cast("string")
    assert one(games.eco_or_pgn(null, F.lit(tag))) == "https://x/openings/Kings-Gambit"
    assert one(games.eco_or_pgn(F.lit("given"), F.lit(tag))) == "given"
    assert one(games.eco_or_pgn(null, F.lit("no tag"))) == "ECO Not Found"
    assert one(games.eco_or_pgn(null, null)) == "ECO Not Found"
    assert one(games.opening_name(F.lit("https://x/openings/Kings-Gambit"))) == "Kings Gambit"
    assert one(games.opening_name(F.lit("ECO Not Found"))) == "ECO Not Found"


def test_game_id(one):
    assert one(games.game_id(F.lit("https://x/game/live/101"))) == 101
    assert one(games.game_id(F.lit("https://x/game/live/abc"), strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(games.game_id(F.lit("https://x/game/live/abc")))


def test_epoch(one):
    assert one(games.epoch_date(F.lit(1730419199))) == D(2024, 10, 31)
    assert one(games.epoch_date(F.lit(1730419200))) == D(2024, 11, 1)
    local = games.epoch_timestamp(F.lit(1719835200), "Europe/London").cast("string")
    assert one(local) == "2024-07-01 13:00:00"


def test_endpoint_parts(one):
    url = F.lit("https://x/pub/player/ann/games/2025/01")
    assert one(paths.player_of(url)) == "ann"
    assert one(paths.period_of(url)) == "2025/01"
    other = F.lit("https://x/pub/leaderboards")
    assert one(paths.player_of(other)) is None
    assert one(paths.period_of(other)) is None
    assert one(paths.endpoint_month(F.lit("player/a/games/2024/10"))) == D(2024, 10, 1)
    assert one(paths.request_url(F.lit("player/a/games/2024/10"), "https://x/")) == "https://x/player/a/games/2024/10"


def test_prefixes(one):
    assert one(paths.add_prefix(F.lit("leaderboards/x"), "raw", ["leaderboards"])) == "leaderboards/x"
    assert one(paths.add_prefix(F.lit("leaderboards2/x"), "raw", ["leaderboards"])) == "raw/leaderboards2/x"
    assert one(paths.add_prefix(F.lit("player/a"), "raw")) == "raw/player/a"
    assert one(paths.rename_prefix(F.lit("raw/raw/a"), "raw", "new")) == "new/raw/a"
    assert one(paths.rename_prefix(F.lit("player/a"), "raw", "new")) == "player/a"


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [
        (D(2025, 1, 1), D(2025, 3, 1), ["2025/01", "2025/02", "2025/03"]),
        (D(2025, 1, 10), D(2025, 3, 31), ["2025/01", "2025/02"]),
        (D(2024, 11, 5), D(2025, 1, 15), ["2024/11", "2024/12"]),
        (D(2025, 5, 1), D(2025, 4, 1), []),
        (D(2025, 1, 31), D(2025, 1, 31), []),
        (D(2025, 1, 31), D(2025, 1, 1), ["2025/01"]),
    ],
)
def test_month_list(one, start, end, months):
    assert one(periods.month_list(F.lit(start), F.lit(end))) == months
    assert periods.month_names(start, end) == months


def test_month_names_equal_the_column(spark):
    days = [D(2023, 11, 1) + dt.timedelta(days=17 * i) for i in range(30)] + [D(2024, 2, 29), D(2024, 1, 1)]
    pairs = spark.createDataFrame([(a, b) for a in days for b in days], "a date, b date")
    for row in pairs.select("a", "b", periods.month_list(F.col("a"), F.col("b")).alias("months")).collect():
        assert periods.month_names(row.a, row.b) == row.months


def test_run_window(one):
    window = one(periods.run_window(day(2025, 1, 20), "PROD"))
    assert tuple(window) == (D(2024, 12, 1), D(2024, 12, 1), "2024/12")
    chosen = one(periods.run_window(day(2025, 1, 20), "TEST", day(2024, 3, 1), day(2024, 4, 1)))
    assert tuple(chosen) == (D(2024, 3, 1), D(2024, 4, 1), "2024/03")
    with pytest.raises(ValueError):
        periods.run_window(day(2025, 1, 20), "TEST")


def test_month_boundaries(one):
    bounds = one(periods.month_boundaries(day(2024, 3, 31)))
    assert tuple(bounds) == (D(2024, 3, 1), D(2024, 3, 31), D(2024, 2, 1), D(2024, 2, 29))
    assert tuple(one(periods.previous_month(day(2025, 1, 1)))) == (D(2024, 12, 1), D(2024, 12, 31))


@pytest.mark.parametrize(
    ("pct", "label"), [(12.25, "12.2%"), (12.35, "12.3%"), (0.15, "0.1%"), (62.5, "62.5%"), (100.0, "100.0%"), (0.0, "0.0%")]
)
def test_pct_label(one, pct, label):
    assert one(labels.pct_label(F.lit(pct))) == label == f"{pct:.1f}%"


def test_pct_of_nothing(one):
    assert one(labels.win_pct(F.lit(0), F.lit(0))) is None
    assert one(labels.pct_label(labels.win_pct(F.lit(0), F.lit(0)))) is None


@pytest.mark.parametrize(
    ("key", "value", "whole", "label"),
    [
        ("current_month_free_tier_used", 12.345, False, "12.35%"),
        ("previous_month_gb_consumed", 1234.56, False, "1234.6GB"),
        ("average_data_bill_per_query", 1234.5678, False, "1,234.568 GB"),
        ("average_USD_cost_per_query", 1234.5, False, "$1,234.50"),
        ("total_number_of_queries", 1234567.0, True, "1,234,567"),
        ("seconds", 1234.5, False, "1,234.50"),
        # The first matching name decides.
        ("current_month_gb_consumed", 1.0, False, "1.00%"),
    ],
)
def test_kpi_label(one, key, value, whole, label):
    assert one(labels.kpi_label(F.lit(key), F.lit(value), F.lit(whole))) == label


def test_text_labels(one):
    strings = "array<string>"
    assert one(labels.prettify(F.lit("total_games"))) == "Total Games"
    assert one(labels.scope_label(F.lit(None).cast(strings))) == "All"
    assert one(labels.scope_label(F.array().cast(strings))) == "All"
    assert one(labels.scope_label(F.array(F.lit("blitz"), F.lit("all")))) == "All"
    assert one(labels.scope_label(F.array(F.lit("blitz"), F.lit("RAPID")))) == "Blitz, Rapid"
    assert one(labels.chart_title(F.array(F.lit("blitz")), "Games")) == "Blitz | Games"
    assert one(labels.or_undefined(F.lit(None).cast("string"))) == "Undefined"


def test_keep_tail(one):
    text = "a" * 500 + "b" * 1500
    assert one(labels.keep_tail(F.lit(text))) == "...(truncated)...\n" + "b" * 1500
    assert one(labels.keep_tail(F.lit("é" * 1500))) == "é" * 1500


def test_job_columns(one):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    end = F.lit("2024-01-01 00:00:01.5009").cast("timestamp")
    assert one(jobs.elapsed_ms(start, end)) == 1500
    billed = F.lit(2 * 10**12)
    assert one(jobs.in_unit(billed, jobs.MEGA)) == 2_000_000
    assert one(jobs.in_unit(billed, jobs.GIGA)) == 2_000
    assert one(jobs.query_cost(billed)) == 12.5
