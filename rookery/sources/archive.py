"""Archive objects and the landing table of responses.

Two layouts hold the same documents.  *Objects*: one JSON document per
``player/<p>/games/<YYYY>/<MM>`` path, in files of their own or in bundles.  *Landing table*: one row per response,
partitioned by period, in files of a size that suits a large cluster.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery import schemas
from rookery.functions import paths
from rookery.sources import objects

list_objects = objects.list_objects


def read_objects(spark: SparkSession, root: str, period: str, endpoint: str | None = None) -> DataFrame:
    """Documents of a period as ``endpoint, body`` (A1); or the one object named."""
    listed = list_objects(spark, root, None if endpoint else period)
    return objects.read_listed(listed if endpoint is None else listed.where(F.col("path") == endpoint), root)


def landing_rows(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses ``url, body`` as landing rows, and those with an unknown URL (A5)."""
    keyed = responses.withColumns({"player": paths.player_of(F.col("url")), "period": paths.period_of(F.col("url"))})
    known = keyed.where("player IS NOT NULL")
    rows = known.withColumn("endpoint", paths.endpoint(F.col("player"), F.col("period")))
    return rows.select(*schemas.LANDING.fieldNames()), keyed.where("player IS NULL").select("url", "body")


def land_responses(responses: DataFrame, location: str) -> DataFrame:
    """Append responses to the landing table; return those with an unknown URL (A5).

    Rows are gathered per period, and a large period is split over many tasks.
    """
    rows, unknown = landing_rows(responses)
    rows.hint("rebalance", "period").write.mode("append").partitionBy("period").parquet(location)
    return unknown


def read_landing(spark: SparkSession, location: str, period: str | None = None) -> DataFrame:
    """Landed documents, of one period if given: only its partition is read (A1)."""
    landed = spark.read.schema(schemas.readable(schemas.LANDING)).parquet(location)
    return landed if period is None else landed.where(F.col("period") == period)


def write_leaderboards(boards: DataFrame, location: str, fetched_at: dt.datetime) -> None:
    """Replace the leaderboard snapshot (A4)."""
    boards.withColumn("_fetched_at", F.lit(fetched_at)).write.mode("overwrite").parquet(location)


def append_leaderboards(boards: DataFrame, location: str, fetched_at: dt.datetime) -> None:
    """Append to the dated leaderboard snapshots (A4)."""
    stamped = boards.withColumns({"_fetched_at": F.lit(fetched_at), "snapshot_date": F.lit(fetched_at.date())})
    stamped.write.mode("append").partitionBy("snapshot_date").parquet(location)
