"""Warehouse usage: cost and volume per user and day, series and KPIs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from rookery.functions import jobs, periods

# Fixed value: gigabytes a month that cost nothing.
FREE_TIER_GB = 1000

JOB_TABLE_COLUMNS = (
    "job_creation_dt",
    "project_id",
    "user_email",
    "job_id",
    "job_type",
    "statement_type",
    "priority",
    "cache_hit",
    "total_slot_seconds",
    "total_gigabytes_billed",
    "query_cost_usd",
)


def _as_date(day: dt.date | str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def rolling_window(job_log: DataFrame, as_of: dt.date | str, days: int = 365) -> DataFrame:
    """Jobs that ended in the ``days`` before ``as_of``, both ends included (C4)."""
    day = _as_date(as_of)
    return job_log.where(F.to_date("end_time").between(F.date_sub(day, days), day))


def job_facts(job_log: DataFrame, usd_per_terabyte: float = jobs.USD_PER_TERABYTE) -> DataFrame:
    """Job log with time parts, durations, volumes and cost."""
    ms = jobs.elapsed_ms(F.col("start_time"), F.col("end_time"))
    processed, billed = F.col("total_bytes_processed"), F.col("total_bytes_billed")
    return job_log.select(
        *[c.alias(name) for name, c in jobs.time_parts(F.col("creation_time")).items()],
        "project_id",
        "user_email",
        "job_id",
        "start_time",
        "end_time",
        "job_type",
        "statement_type",
        "priority",
        "cache_hit",
        ms.alias("total_query_ms"),
        (ms * jobs.MILLI).alias("total_query_seconds"),
        "total_slot_ms",
        (F.col("total_slot_ms") * jobs.MILLI).alias("total_slot_seconds"),
        "total_bytes_processed",
        jobs.in_unit(processed, jobs.MEGA).alias("total_megabytes_processed"),
        jobs.in_unit(processed, jobs.GIGA).alias("total_gigabytes_processed"),
        "total_bytes_billed",
        jobs.in_unit(billed, jobs.MEGA).alias("total_megabytes_billed"),
        jobs.in_unit(billed, jobs.GIGA).alias("total_gigabytes_billed"),
        jobs.query_cost(billed, usd_per_terabyte).alias("query_cost_usd"),
    )


def user_day(facts: DataFrame) -> DataFrame:
    """Queries, seconds, volumes and cost per project, day and user.

    Unknown users form a group of their own.
    """
    return facts.groupBy("project_id", "job_created_date", "user_email").agg(
        F.count(F.lit(1)).alias("number_of_queries"),
        F.sum("total_query_seconds").alias("total_query_seconds"),
        F.sum("total_slot_seconds").alias("total_slot_seconds"),
        F.sum("total_gigabytes_processed").alias("total_gigabytes_processed"),
        F.sum("total_gigabytes_billed").alias("total_gigabytes_billed"),
        F.sum("query_cost_usd").alias("total_query_cost_usd"),
    )


def _in_range(start: dt.date | str | Column, end: dt.date | str | Column) -> Column:
    return F.col("job_created_date").between(_as_date(start), _as_date(end))


def usage_filter(
    rows: DataFrame,
    start: dt.date | str | Column,
    end: dt.date | str | Column,
    users: Sequence[str] | None = None,
    fixed_range: bool = False,
) -> DataFrame:
    """Rows of a date range, of the chosen users unless the range is a fixed one."""
    rows = rows.where(_in_range(start, end))
    if users and not fixed_range:
        rows = rows.where(F.col("user_email").isin(list(users)))
    return rows


def jobs_over(facts: DataFrame, gigabytes: float | None) -> DataFrame:
    """Jobs billed at least ``gigabytes``."""
    return facts if gigabytes is None else facts.where(F.col("total_gigabytes_billed") >= gigabytes)


def daily_series(rows: DataFrame, metric: str = "total_gigabytes_billed") -> DataFrame:
    """Sum of a numeric column per day."""
    if not isinstance(rows.schema[metric].dataType, NumericType):
        raise ValueError(f"{metric} is not numeric")
    return rows.groupBy("job_created_date").agg(F.coalesce(F.sum(metric), F.lit(0)).alias(metric))


def numeric_metrics(rows: DataFrame) -> list[str]:
    """Columns a daily series can show, sorted."""
    return sorted(f.name for f in rows.schema.fields if isinstance(f.dataType, NumericType))


def usage_kpis(
    user_days: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    users: Sequence[str] | None = None,
    free_tier_gb: int = FREE_TIER_GB,
) -> DataFrame:
    """Queries, distinct users, averages per query, and free tier used this month.

    The range and the user choice apply to all but the free tier, which covers
    the month of ``as_of`` for everyone.  One pass over the user days.
    """
    chosen = _in_range(start, end)
    if users:
        chosen = chosen & F.col("user_email").isin(list(users))
    bounds = periods.month_boundaries(_as_date(as_of))
    this_month = _in_range(bounds["current_month_start"], bounds["current_month_end"])

    def total(metric: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(metric))), F.lit(0))

    sums = user_days.agg(
        total("number_of_queries", chosen).alias("total_number_of_queries"),
        F.count_distinct(F.when(chosen, F.col("user_email"))).alias("distinct_users"),
        total("total_query_cost_usd", chosen).alias("cost"),
        total("total_gigabytes_billed", chosen).alias("billed"),
        total("total_gigabytes_billed", this_month).alias("month_billed"),
    )
    queries = F.col("total_number_of_queries")
    return sums.select(
        "total_number_of_queries",
        "distinct_users",
        F.try_divide("cost", queries).alias("average_usd_cost_per_query"),
        F.try_divide("billed", queries).alias("average_data_bill_per_query"),
        (F.col("month_billed") / free_tier_gb * 100).alias("current_month_free_tier_used"),
    )


def month_over_month(user_days: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Billed volume of this and the previous month and its change in percent.

    The change is 0 when the previous month had none.
    """
    bounds = periods.month_boundaries(_as_date(as_of))

    def billed(which: str) -> Column:
        in_month = _in_range(bounds[f"{which}_month_start"], bounds[f"{which}_month_end"])
        return F.coalesce(F.sum(F.when(in_month, F.col("total_gigabytes_billed"))), F.lit(0.0))

    sums = user_days.agg(
        billed("current").alias("current_month_gb_consumed"),
        billed("previous").alias("previous_month_gb_consumed"),
    )
    current, previous = F.col("current_month_gb_consumed"), F.col("previous_month_gb_consumed")
    change = F.when(previous != 0, F.try_divide(current - previous, previous) * 100).otherwise(F.lit(0.0))
    return sums.withColumn("percentage_difference", change)


def default_window(user_days: DataFrame, days: int = 60) -> DataFrame:
    """Last ``days`` of the data, and the earliest and latest date to choose from."""
    return user_days.agg(
        F.min("job_created_date").alias("min_date_allowed"),
        F.max("job_created_date").alias("max_date_allowed"),
    ).select(
        F.date_sub("max_date_allowed", days).alias("start_date"),
        F.col("max_date_allowed").alias("end_date"),
        "min_date_allowed",
        "max_date_allowed",
    )


def jobs_table(facts: DataFrame) -> DataFrame:
    """Jobs, newest first, with the shown columns (F2)."""
    return facts.select(*JOB_TABLE_COLUMNS).orderBy(F.desc("job_creation_dt"), "job_id")
