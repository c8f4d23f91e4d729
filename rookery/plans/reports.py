"""The opening report and the usage report: named frames over one base (H5, H6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame

from rookery.operators import openings, usage
from rookery.sources import tables

#: What can be chosen in the opening report.
DIMENSIONS = ("time_class", "opening_archetype")


@contextmanager
def opening_report(
    weekly: DataFrame,
    start: dt.date,
    end: dt.date,
    time_class: str | Sequence[str] | None = None,
    chosen_openings: Sequence[str] | None = None,
    minimum: int | None = None,
    color: str | None = None,
) -> Iterator[dict[str, DataFrame]]:
    """All frames of the opening report (H5), with its lists of dimensions and heat map.

    The three aggregates come out of one expansion of the filtered base, which is written to the scratch
    folder; every figure derives from it.  The lists are those of all weeks of ``weekly``.
    """
    base = openings.dimension_filter(openings.week_range(weekly, start, end), time_class, chosen_openings)
    grouped = tables.stage(openings.grouped_counts(base), "opening-report")
    by_opening = openings.at_level(grouped, ["opening_archetype"], minimum)
    weekly_opening = openings.at_level(grouped, ["week_start", "opening_archetype"], minimum, with_pct=False)
    timeclass_opening = openings.at_level(grouped, ["time_class", "opening_archetype"], minimum)
    yield {
        "opening": by_opening,
        "weekly_opening": weekly_opening,
        "timeclass_opening": timeclass_opening,
        "weekly_totals": openings.weekly_totals(weekly_opening),
        "hierarchy": openings.opening_hierarchy(by_opening),
        "points": openings.win_rate_points(by_opening, color),
        "top": openings.top_openings(by_opening),
        "kpis": openings.opening_kpis(by_opening),
        "stats": openings.win_pct_stats(by_opening, color),
        "histogram": openings.win_pct_histogram(by_opening, color),
        "curve": openings.normal_curve(by_opening, color),
        "dimensions": openings.distinct_dimensions(weekly, DIMENSIONS, with_all=DIMENSIONS[:1]),
        "heat_map": openings.win_pct_pivot(timeclass_opening),
    }


@contextmanager
def usage_report(
    job_log: DataFrame,
    as_of: dt.date,
    start: dt.date,
    end: dt.date,
    users: Sequence[str] | None = None,
    metric: str = "total_gigabytes_billed",
    minimum_gb: float | None = None,
) -> Iterator[dict[str, DataFrame]]:
    """All frames of the usage report (H6), with its users, metrics and default window.

    The job facts and user days are kept for the duration of the ``with`` block: the job log is read once.
    """
    facts = usage.job_facts(usage.rolling_window(job_log, as_of)).persist()
    user_days = usage.user_day(facts).persist()
    chosen_jobs = usage.jobs_over(usage.usage_filter(facts, start, end, users), minimum_gb)
    metrics = usage.numeric_metrics(user_days)
    try:
        yield {
            "user_days": user_days,
            "series": usage.daily_series(usage.usage_filter(user_days, start, end, users), metric),
            "jobs": usage.jobs_table(chosen_jobs),
            "kpis": usage.usage_kpis(user_days, start, end, as_of, users),
            "month_over_month": usage.month_over_month(user_days, as_of),
            "users": user_days.select("user_email").distinct(),
            "metrics": user_days.sparkSession.createDataFrame([(m,) for m in metrics], "metric string"),
            "window": usage.default_window(user_days),
        }
    finally:
        user_days.unpersist()
        facts.unpersist()
