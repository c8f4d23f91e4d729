"""Request planning (H1)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery import schemas
from rookery.functions import paths
from rookery.functions.periods import run_window
from rookery.operators import archive, keys
from rookery.sources import tables


def plan_requests(
    boards: DataFrame,
    start: dt.date,
    end: dt.date,
    base_url: str,
    landed: DataFrame | None = None,
    ledger: DataFrame | None = None,
    skip_failed: bool = True,
) -> DataFrame:
    """Requests still to be made: player, period, endpoint, url.

    Players come from the leaderboards; what is done already from the landed
    endpoints, the request ledger, or both.
    """
    done = [keys.landed_periods(landed)] if landed is not None else []
    if ledger is not None:
        done.append(keys.ledger_periods(ledger, skip_failed))
    players = archive.leaderboard_players(boards)
    todo = (
        keys.remaining_requests(players, start, end, reduce(DataFrame.union, done))
        if done
        else keys.request_grid(players, start, end)
    )
    return todo.select("player", "period", "endpoint", paths.request_url(F.col("endpoint"), base_url).alias("url"))


@dataclass(frozen=True)
class RequestTables:
    """Names of the tables of an ingest: requests still to be made, outcomes of those made."""

    requests: str
    ledger: str

    @classmethod
    def create(cls, spark: SparkSession, database: str, location: str | None = None) -> RequestTables:
        """Create the database and the tables where absent."""
        tables.ensure_database(spark, database, location)
        names = cls(f"{database}.requests", f"{database}.request_ledger")
        tables.ensure_table(spark, names.requests, schemas.REQUESTS, "period")
        tables.ensure_table(spark, names.ledger, schemas.REQUEST_LEDGER, "period")
        return names


def ingest_window(
    spark: SparkSession, as_of: dt.date, mode: str, start: dt.date | None = None, end: dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """First and last day a run asks for: the month before ``as_of`` in ``PROD``, else the given days."""
    given = [F.lit(d) if d else None for d in (start, end)]
    window = spark.range(1).select(run_window(F.lit(as_of), mode, *given).alias("w")).first()["w"]
    return window.start_date, window.end_date


def store_requests(
    spark: SparkSession,
    boards_location: str,
    target: RequestTables,
    window: tuple[dt.date, dt.date],
    base_url: str,
    landed: DataFrame | None = None,
    skip_failed: bool = True,
) -> DataFrame:
    """Plan from the stored leaderboards and the ledger, replace the request table, return it (H1)."""
    boards = spark.read.parquet(boards_location)
    ledger = tables.current(spark, target.ledger)
    todo = plan_requests(boards, *window, base_url, landed, ledger, skip_failed)
    columns = schemas.REQUESTS.fieldNames()
    todo.select(*columns).hint("rebalance", "period").write.mode("overwrite").insertInto(target.requests)
    return tables.current(spark, target.requests)


def record_outcomes(outcomes: DataFrame, target: RequestTables) -> None:
    """Append fetched or failed requests, ``player, period, outcome``, to the ledger."""
    tables.append(outcomes.select(*schemas.REQUEST_LEDGER.fieldNames()), target.ledger, "period")
