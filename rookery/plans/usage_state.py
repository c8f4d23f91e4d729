"""Distinct users of any range of days from stored bitmaps, without reading the job log again.

Every user has a number.  The users of a day are bitmaps, one for each 32,768 numbers that
occur; those of a range are the union of its days' bitmaps, and their count is exact.  A union
takes no notice of repetition, so a day that is stored twice, or bit by bit, counts the same.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery import schemas
from rookery.sources import tables


@dataclass(frozen=True)
class UsageState:
    """Names of the tables: numbers of the users, and bitmaps by day."""

    users: str
    days: str

    @classmethod
    def create(cls, spark: SparkSession, database: str, location: str | None = None) -> UsageState:
        """Create the database and the tables where absent."""
        tables.ensure_database(spark, database, location)
        names = cls(f"{database}.user_numbers", f"{database}.user_days")
        tables.ensure_table(spark, names.users, schemas.USER_NUMBERS)
        tables.ensure_table(spark, names.days, schemas.USER_DAYS, "job_created_date")
        return names


def _numbered(users: DataFrame, state: UsageState) -> DataFrame:
    """Numbers of all users; those met for the first time are stored first.

    New numbers start above the largest known one and need not be dense: no task counts all users.
    """
    spark = users.sparkSession
    known = tables.current(spark, state.users)
    new = users.join(known.select("user_email"), "user_email", "left_anti")
    above = F.coalesce(known.agg(F.max("user_number")).select("max(user_number)").scalar(), F.lit(-1)) + 1
    numbered = tables.stage(new.select("user_email", F.monotonically_increasing_id().alias("user_number")), "new-users")
    tables.append(numbered.select("user_email", (F.col("user_number") + above).alias("user_number")), state.users)
    return tables.current(spark, state.users)


def store_days(facts: DataFrame, state: UsageState) -> None:
    """Add the users of the facts to the bitmaps of their days; unknown users count as none."""
    active = facts.where("user_email IS NOT NULL").select("job_created_date", "user_email").distinct()
    active = tables.stage(active, "active-users")
    numbers = _numbered(active.select("user_email").distinct(), state)
    marked = active.join(numbers, "user_email")
    bitmaps = marked.groupBy("job_created_date", F.bitmap_bucket_number("user_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_number")).alias("bitmap")
    )
    tables.append(bitmaps, state.days, "job_created_date")


def distinct_users(spark: SparkSession, state: UsageState, start: dt.date, end: dt.date) -> DataFrame:
    """Users of the days from ``start`` to ``end``, both included."""
    days = tables.current(spark, state.days).where(F.col("job_created_date").between(F.lit(start), F.lit(end)))
    union = days.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return union.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("distinct_users"))


def rolling_users(spark: SparkSession, state: UsageState, days: int) -> DataFrame:
    """Users of the ``days`` days that end with each stored day: end_date, distinct_users."""
    stored = tables.current(spark, state.days)
    last = stored.agg(F.max("job_created_date")).select("max(job_created_date)").scalar()
    ends = F.sequence("job_created_date", F.least(F.date_add("job_created_date", days - 1), last))
    wanted = stored.select("job_created_date").distinct()
    spread = stored.select(F.explode(ends).alias("end_date"), "bucket", "bitmap")
    spread = spread.join(wanted.withColumnRenamed("job_created_date", "end_date"), "end_date", "left_semi")
    union = spread.groupBy("end_date", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return union.groupBy("end_date").agg(F.sum(F.bitmap_count("bitmap")).alias("distinct_users"))
