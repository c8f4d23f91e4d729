"""The weekly openings table that the reports read, kept up to date load by load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery import schemas
from rookery.operators.openings import build_weekly_openings, week_of
from rookery.sources import tables


def create_weekly_openings(spark: SparkSession, name: str) -> None:
    """Create the table where absent, partitioned by week."""
    tables.ensure_table(spark, name, schemas.WEEKLY_OPENINGS, "week_start")


def refresh_weekly_openings(
    games: DataFrame, touched: DataFrame, name: str, archetypes: DataFrame | None = None
) -> None:
    """Count the weeks of the ``game_date`` values in ``touched`` anew and replace their partitions.

    The weeks a load touches are listed (one value each); of the games table
    only the days of these weeks are read.  A run that is repeated writes the same partitions again.
    """
    weeks = [r[0] for r in touched.select(week_of(F.col("game_date"))).distinct().collect()]
    if not weeks:
        return
    days = touched.sparkSession.createDataFrame([(w,) for w in weeks], "week date")
    listed = [r[0] for r in days.select(F.explode(F.sequence("week", F.date_add("week", 6)))).collect()]
    counts = build_weekly_openings(games.where(F.col("game_date").isin(listed)), archetypes)
    tables.replace_partitions(counts.hint("rebalance", "week_start"), name)
