"""Months, run windows and month boundaries, always relative to a given date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_FORMAT = "yyyy/MM"


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def previous_month_start(day: Column) -> Column:
    return F.add_months(month_start(day), -1)


def period(day: Column) -> Column:
    """``YYYY/MM`` of a date."""
    return F.date_format(day, PERIOD_FORMAT)


def month_list(start: Column, end: Column) -> Column:
    """Array of ``YYYY/MM`` from the month of ``start`` to the last whole month (G1).

    An ``end`` on the first of a month includes that month; any later day stops
    at the month before.  Empty when the range is empty.
    """
    first = month_start(start)
    last = F.when(F.dayofmonth(end) > 1, previous_month_start(end)).otherwise(month_start(end))
    months = F.sequence(first, F.greatest(first, last), F.expr("INTERVAL 1 MONTH"))
    return F.when(first <= last, F.transform(months, period)).otherwise(F.array().cast("array<string>"))


def month_names(start: dt.date, end: dt.date) -> list[str]:
    """:func:`month_list` of two known dates, as a constant: no month is formatted per row."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1 - (end.day > 1)
    return [f"{m // 12:04d}/{m % 12 + 1:02d}" for m in range(first, last + 1)]


def run_window(
    as_of: Column,
    environment: str,
    start: Column | None = None,
    end: Column | None = None,
) -> Column:
    """Window of one run as ``struct(start_date, end_date, period)``.

    ``PROD`` runs handle the month before ``as_of``; the others the configured
    dates.
    """
    if environment == "PROD":
        start = end = previous_month_start(as_of)
    elif start is None or end is None:
        raise ValueError(f"{environment} runs need a start and an end date")
    return F.struct(start.alias("start_date"), end.alias("end_date"), period(start).alias("period"))


def month_boundaries(as_of: Column) -> Column:
    """First and last day of the current and the previous month."""
    current = month_start(as_of)
    return F.struct(
        current.alias("current_month_start"),
        F.last_day(as_of).alias("current_month_end"),
        F.add_months(current, -1).alias("previous_month_start"),
        F.date_sub(current, 1).alias("previous_month_end"),
    )


def previous_month(as_of: Column) -> Column:
    """The whole previous month, the default range of the opening report."""
    bounds = month_boundaries(as_of)
    return F.struct(
        bounds["previous_month_start"].alias("start_date"),
        bounds["previous_month_end"].alias("end_date"),
    )
