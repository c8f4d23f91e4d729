"""Usage statistics: fixture cases of FIXTURES.md."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from rookery import schemas
from rookery.operators import usage as ops
from rookery.plans.reports import usage_report
from rookery.plans.usage_state import UsageState, distinct_users, rolling_users, store_days
from rookery.session import scratch_path
from rookery.sources import tables

AS_OF = dt.date(2025, 3, 15)


def job(created, user, billed_gb, job_id="j", end=None, slot_ms=1000):
    start = dt.datetime.fromisoformat(created)
    size = int(billed_gb * 10**9)
    end = end or start + dt.timedelta(seconds=1.5)
    return (start, "p", user, job_id, start, end, "QUERY", "SELECT", "INTERACTIVE", False, slot_ms, size, size)


JOBS = [
    job("2025-03-01T00:00:00", "ann", 100, "a"),
    job("2025-03-10T10:00:00", "ann", 300, "b"),
    job("2025-03-10T11:00:00", None, 50, "c"),
    job("2025-02-28T23:59:59", "bob", 200, "d"),
    job("2025-02-01T00:00:00", "bob", 25, "e"),
    job("2025-01-31T12:00:00", "ann", 10, "f"),
]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(JOBS, schemas.JOB_LOG)


@pytest.fixture
def days(log):
    return ops.user_day(ops.job_facts(log))


def test_facts(spark):
    start = dt.datetime(2024, 1, 1)
    end = dt.datetime(2024, 1, 1, 0, 0, 1, 500900)
    row = job("2024-01-01T00:00:00", "ann", 2000, end=end)
    facts = ops.job_facts(spark.createDataFrame([row], schemas.JOB_LOG)).first()
    assert (facts.total_query_ms, facts.total_query_seconds) == (1500, 1.5)
    assert (facts.total_megabytes_billed, facts.total_gigabytes_billed) == (2_000_000, 2_000)
    assert facts.query_cost_usd == 12.5
    assert (facts.job_creation_dt, facts.job_created_month) == (start, dt.date(2024, 1, 1))


def test_rolling_window(spark):
    kept = dt.datetime(2025, 3, 15, 23, 59) - dt.timedelta(days=365)
    dropped = dt.datetime(2025, 3, 15, 0, 0) - dt.timedelta(days=366)
    future = dt.datetime(2025, 3, 16)
    rows = [job("2024-01-01T00:00:00", "ann", 1, str(i), end) for i, end in enumerate((kept, dropped, future))]
    got = ops.rolling_window(spark.createDataFrame(rows, schemas.JOB_LOG), AS_OF)
    assert [r.job_id for r in got.collect()] == ["0"]


def test_user_day_keeps_unknown_users(days):
    got = {(r.job_created_date, r.user_email): r for r in days.collect()}
    assert len(got) == 6
    assert got[(dt.date(2025, 3, 10), None)].total_gigabytes_billed == 50


def test_filter(days):
    assert ops.usage_filter(days, "2025-03-01", "2025-03-10").count() == 3
    assert ops.usage_filter(days, "2025-03-01", "2025-03-10", ["ann"]).count() == 2
    assert ops.usage_filter(days, "2025-03-01", "2025-03-10", ["ann"], fixed_range=True).count() == 3


def test_jobs_over_is_inclusive(log):
    facts = ops.job_facts(log)
    assert {r.job_id for r in ops.jobs_over(facts, 100).collect()} == {"a", "b", "d"}
    assert ops.jobs_over(facts, None).count() == 6


def test_kpis(days):
    # The month of as_of counts for every user, whatever users are chosen.
    kpis = ops.usage_kpis(days, "2025-02-01", "2025-03-31", AS_OF, ["ann"]).first()
    assert (kpis.total_number_of_queries, kpis.distinct_users) == (2, 1)
    assert kpis.average_data_bill_per_query == 200
    assert kpis.average_usd_cost_per_query == pytest.approx(1.25)
    assert kpis.current_month_free_tier_used == 45.0
    everyone = ops.usage_kpis(days, "2025-01-01", "2025-03-31", AS_OF).first()
    assert (everyone.total_number_of_queries, everyone.distinct_users) == (6, 2)


def test_kpis_without_queries(days):
    kpis = ops.usage_kpis(days, "2020-01-01", "2020-01-31", dt.date(2020, 1, 1)).first()
    assert tuple(kpis) == (0, 0, None, None, 0.0)


def test_month_over_month(days):
    # The first of each month is part of it.
    assert tuple(ops.month_over_month(days, AS_OF).first()) == (450.0, 225.0, 100.0)
    assert tuple(ops.month_over_month(days, dt.date(2025, 1, 5)).first()) == (10.0, 0.0, 0.0)


def test_series_and_window(days):
    series = {r.job_created_date: r.total_gigabytes_billed for r in ops.daily_series(days).collect()}
    assert series[dt.date(2025, 3, 10)] == 350
    with pytest.raises(ValueError):
        ops.daily_series(days, "user_email")
    assert "number_of_queries" in ops.numeric_metrics(days)
    window = ops.default_window(days).first()
    assert tuple(window) == (dt.date(2025, 1, 9), dt.date(2025, 3, 10), dt.date(2025, 1, 31), dt.date(2025, 3, 10))


def test_report_and_csv(spark, log, tmp_path):
    with usage_report(log, AS_OF, dt.date(2025, 3, 1), dt.date(2025, 3, 31), minimum_gb=100) as report:
        assert [r.job_id for r in report["jobs"].collect()] == ["b", "a"]
        assert len(report["jobs"].columns) == 11
        assert report["series"].count() == 2
        assert report["kpis"].first().total_number_of_queries == 3
        assert report["month_over_month"].first().percentage_difference == 100.0
        tables.export_csv(report["jobs"], str(tmp_path / "csv"))
        back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
        assert back.columns == report["jobs"].columns and back.count() == 2
        assert "number_of_queries" in {r.metric for r in report["metrics"].collect()}
        assert report["window"].count() == 1 and report["users"].count() >= 1
        plan = report["kpis"]._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan


def test_distinct_users_from_bitmaps(spark):
    name = f"t_{uuid.uuid4().hex}"
    state = UsageState.create(spark, name, scratch_path(spark, name))
    first = dt.date(2025, 1, 1)
    rows = [(first + dt.timedelta(days=i % 9), f"u{i * 7 % 40}" if i % 11 else None) for i in range(200)]

    def frame(part):
        return spark.createDataFrame(part, "job_created_date date, user_email string").repartition(3)

    def users(a, b):
        return distinct_users(spark, state, first + dt.timedelta(days=a), first + dt.timedelta(days=b)).first()[0]

    # Bit by bit, out of order, and some of it twice.
    for part in (rows[120:], rows[:80], rows[60:130], []):
        store_days(frame(part), state)
    for a in range(9):
        for b in range(a, 10):
            want = {u for d, u in rows if u and a <= (d - first).days <= b}
            assert users(a, b) == len(want)
    assert users(20, 30) == 0
    known = spark.table(state.users).collect()
    assert len({r.user_number for r in known}) == len(known) == len({u for _, u in rows if u})
    rolling = {r.end_date: r.distinct_users for r in rolling_users(spark, state, 3).collect()}
    assert rolling == {
        d: len({u for e, u in rows if u and 0 <= (d - e).days < 3}) for d in {d for d, u in rows if u}
    }
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_csv_keeps_microseconds(spark, tmp_path):
    when = dt.datetime(2025, 1, 20, 12, 0, 0, 123456)
    rows = spark.createDataFrame([(1, when, None), (2, when.replace(microsecond=0), "a,b")], "n int, t timestamp, s string")
    tables.export_csv(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).options(**tables.CSV_TIMES).schema(rows.schema).csv(str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
