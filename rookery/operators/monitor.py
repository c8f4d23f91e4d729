"""Run monitor rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery import schemas
from rookery.functions.labels import keep_tail

# Fixed value: environment of a run that names none.
NO_ENVIRONMENT = "UNDEFINED"


def triggered_runs(runs: DataFrame) -> DataFrame:
    """Rows of ``runs_triggered`` out of raw run records (H7).

    The start time is floored to the second; a run without an environment is
    ``UNDEFINED``.
    """
    started = F.date_trunc("second", F.col("started_at")).cast("timestamp")
    return runs.select(
        "run_id",
        F.to_date(started).alias("run_start_date"),
        started.alias("run_start_dt"),
        "script_name",
        F.coalesce("environment", F.lit(NO_ENVIRONMENT)).alias("environment"),
        "hostname",
        "python_version",
    ).select(*schemas.RUNS_TRIGGERED.fieldNames())


def failed_runs(runs: DataFrame, max_chars: int = 1500) -> DataFrame:
    """Rows of ``runs_failed`` out of raw failure records."""
    failed = F.date_trunc("second", F.col("failed_at")).cast("timestamp")
    return runs.select(
        "run_id",
        F.to_date(failed).alias("run_failed_date"),
        failed.alias("run_failed_dt"),
        F.col("script_name").alias("failed_filename"),
        "exception_type",
        "exception_value",
        keep_tail(F.col("stack_trace"), max_chars).alias("stack_trace"),
    ).select(*schemas.RUNS_FAILED.fieldNames())
