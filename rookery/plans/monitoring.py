"""Recording triggered and failed runs (H7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rookery import schemas
from rookery.operators import monitor, quality
from rookery.sources import tables


@dataclass(frozen=True)
class MonitorTables:
    """Names of the two monitor tables."""

    triggered: str
    failed: str

    @classmethod
    def create(cls, spark: SparkSession, database: str, location: str | None = None) -> MonitorTables:
        """Create the database and both tables where absent."""
        tables.ensure_database(spark, database, location)
        names = cls(triggered=f"{database}.runs_triggered", failed=f"{database}.runs_failed")
        tables.ensure_table(spark, names.triggered, schemas.RUNS_TRIGGERED, "run_start_date")
        tables.ensure_table(spark, names.failed, schemas.RUNS_FAILED, "run_failed_date")
        return names


def record_triggered(runs: DataFrame, target: MonitorTables) -> None:
    """Append started runs; every column is required."""
    rows = quality.check(monitor.triggered_runs(runs), schemas.required_paths(schemas.RUNS_TRIGGERED))
    tables.append(rows, target.triggered, "run_start_date")


def record_failed(runs: DataFrame, target: MonitorTables) -> None:
    """Append failed runs; every column is required."""
    rows = quality.check(monitor.failed_runs(runs), schemas.required_paths(schemas.RUNS_FAILED))
    tables.append(rows, target.failed, "run_failed_date")
