"""Columns of the usage report derived from a warehouse job log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal units and the price of a billed terabyte.
MILLI = 0.001
MEGA = 10**6
GIGA = 10**9
TERA = 10**12
USD_PER_TERABYTE = 6.25


def elapsed_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between two timestamps."""
    return F.timestamp_diff("MILLISECOND", start, end)


def in_unit(amount: Column, unit: int) -> Column:
    """Bytes in a decimal unit, as double."""
    return amount / F.lit(unit)


def query_cost(billed_bytes: Column, usd_per_terabyte: float = USD_PER_TERABYTE) -> Column:
    """Price of a query from its billed bytes."""
    return in_unit(billed_bytes, TERA) * F.lit(usd_per_terabyte)


def time_parts(created: Column) -> dict[str, Column]:
    """Creation time, date and month start of a job."""
    day = F.to_date(created)
    return {
        "job_creation_dt": created,
        "job_created_date": day,
        "job_created_month": F.trunc(day, "MM"),
    }
