"""Windowed counts over streams (S4): open windows in the state store, late rows in a table of corrections.

A run has two steps.  The first counts every micro-batch of new rows by window and
key, without state, and parts the counts by the boundary up to which windows
were closed by the runs before: counts of open windows go on, those of closed ones are
corrections.  The second adds the counts of open windows up under an event-time watermark; a window that the
watermark has passed leaves the state and is delivered.  So state holds open
windows only, and no row is too late.

The boundary of a run is written before the second step can move the watermark to it.  A run that stops
anywhere is repeated: at worst its successor takes rows of a window that is still open for corrections, which are added all the same.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from rookery.streaming.runs import stream_session

#: Time of the newest row of a group of rows: moves the watermark as the rows themselves would.
NEWEST = "newest"


def day_window(event_time: str) -> Column:
    """Calendar days, UTC."""
    return F.window(event_time, "1 day")


def week_window(event_time: str) -> Column:
    """Weeks from Monday; the epoch was a Thursday, hence the offset."""
    return F.window(event_time, "7 days", "7 days", "4 days")


@dataclass(frozen=True)
class WindowedCounts:
    """Sums of ``values`` (SQL of a row) by window and ``keys``; ``start`` names the date a window begins with.

    Rows without an event time lie in no window.
    """

    event_time: str
    window: Callable[[str], Column]
    start: str
    keys: tuple[str, ...]
    values: Mapping[str, str]

    def batch(self, rows: DataFrame) -> DataFrame:
        """The counts of all rows at once."""
        return self.dated(self._summed(rows, self.event_time, self.values))

    def partial(self, rows: DataFrame) -> DataFrame:
        """Counts of one micro-batch, with the time of the newest row of each."""
        newest = F.max(self.event_time).alias(NEWEST)
        return self._summed(rows, self.event_time, self.values, newest).drop("window")

    def total(self, partials: DataFrame) -> DataFrame:
        """Counts added up over micro-batches."""
        return self._summed(partials, NEWEST, {name: name for name in self.values})

    def dated(self, counted: DataFrame) -> DataFrame:
        return counted.select(F.to_date("window.start").alias(self.start), *self.keys, *self.values)

    def _summed(self, rows: DataFrame, time: str, values: Mapping[str, str], *more: Column) -> DataFrame:
        sums = [F.sum(F.expr(value)).alias(name) for name, value in values.items()]
        return rows.groupBy(self.window(time).alias("window"), *self.keys).agg(*sums, *more)


#: Queries, seconds, volumes and cost per project, day and user.
DAILY_USAGE = WindowedCounts(
    "job_creation_dt",
    day_window,
    "job_created_date",
    ("project_id", "user_email"),
    {
        "number_of_queries": "1L",
        "total_query_seconds": "total_query_seconds",
        "total_slot_seconds": "total_slot_seconds",
        "total_gigabytes_processed": "total_gigabytes_processed",
        "total_gigabytes_billed": "total_gigabytes_billed",
        "total_query_cost_usd": "query_cost_usd",
    },
)


#: Games and wins per week and opening (E3); of the games table, which holds each game once.
WEEKLY_GAMES = WindowedCounts(
    "end_dt",
    week_window,
    "week_start",
    ("time_class", "opening"),
    {
        "total_games": "1L",
        "white_win_count": "IF(white.result = 'win', 1L, 0L)",
        "black_win_count": "IF(black.result = 'win', 1L, 0L)",
    },
)


@dataclass(frozen=True)
class CountStore:
    """Folders of one windowed count: counts on their way, delivered windows, corrections, boundaries, checkpoints."""

    root: str

    @property
    def partials(self) -> str:
        return f"{self.root}/partials"

    @property
    def closed(self) -> str:
        return f"{self.root}/closed"

    @property
    def corrections(self) -> str:
        return f"{self.root}/corrections"

    @property
    def boundaries(self) -> str:
        return f"{self.root}/boundaries"

    def checkpoint(self, step: str) -> str:
        return f"{self.root}/checkpoint-{step}"


def _read(spark: SparkSession, location: str, schema: StructType | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(location)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def boundary(spark: SparkSession, store: CountStore) -> dt.datetime | None:
    """Windows that end here or before are closed; none before the first run."""
    known = _read(spark, store.boundaries)
    return known.agg(F.max("closed_until")).first()[0] if known is not None else None


def _start_partials(
    rows: DataFrame, counts: WindowedCounts, store: CountStore, closed_until: dt.datetime | None
) -> StreamingQuery:
    """Count each micro-batch, apart from its closed windows; a replayed batch replaces its own counts."""
    late = F.lit(False)
    if closed_until is not None:
        late = counts.window(NEWEST)["end"] <= F.lit(closed_until)

    def write(batch: DataFrame, number: int) -> None:
        counted = counts.partial(batch).withColumn("late", late).persist()
        try:
            for flag, folder in ((False, store.partials), (True, store.corrections)):
                part = counted.where(F.col("late") == flag).drop("late")
                part.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        finally:
            counted.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", store.checkpoint("partials"))
        .trigger(availableNow=True)
        .start()
    )


def partial_schema(rows: DataFrame, counts: WindowedCounts) -> StructType:
    return counts.partial(rows.sparkSession.createDataFrame([], rows.schema)).schema


def _start_totals(
    spark: SparkSession, schema: StructType, counts: WindowedCounts, store: CountStore, delay: str
) -> StreamingQuery:
    """Add up the counts of open windows in state; windows the watermark has passed are appended to ``closed``.

    All that the first step has written is one micro-batch, so no count in it can be behind the watermark.
    """
    own = stream_session(spark)
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    partials = (
        own.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("cleanSource", "delete")
        .parquet(store.partials)
    )
    closed = counts.dated(counts.total(partials.withWatermark(NEWEST, delay)))
    return (
        closed.writeStream.format("parquet")
        .outputMode("append")
        .option("path", store.closed)
        .option("checkpointLocation", store.checkpoint("totals"))
        .trigger(availableNow=True)
        .start()
    )


def run_counts(rows: DataFrame, counts: WindowedCounts, store: CountStore, delay: str = "1 day") -> StreamingQuery:
    """Count all available rows of a stream; returns the finished second step."""
    spark = rows.sparkSession
    _start_partials(rows, counts, store, boundary(spark, store)).awaitTermination()
    schema = partial_schema(rows, counts)
    partials = _read(spark, store.partials, schema)
    if partials is not None:
        until = partials.agg((F.max(NEWEST) - F.expr(f"INTERVAL {delay}")).alias("closed_until"))
        until.where("closed_until IS NOT NULL").coalesce(1).write.mode("append").parquet(store.boundaries)
    totals = _start_totals(spark, schema, counts, store, delay)
    totals.awaitTermination()
    return totals


def delivered(spark: SparkSession, counts: WindowedCounts, store: CountStore) -> DataFrame | None:
    """Closed windows, with what came late for them."""
    parts = [_read(spark, store.closed)]
    late = _read(spark, store.corrections)
    if late is not None:
        parts.append(counts.dated(counts.total(late)))
    return _added([p for p in parts if p is not None], counts)


def open_windows(spark: SparkSession, counts: WindowedCounts, store: CountStore) -> DataFrame:
    """Counts so far of the windows that the state still holds."""
    state = spark.read.format("statestore").load(store.checkpoint("totals"))
    state = state.select(*[F.col(c).cast(_numbered(state.schema[c].dataType)).alias(c) for c in ("key", "value")])
    first = len(state.schema["value"].dataType) - len(counts.values)
    return state.select(
        F.to_date("key.f0.start").alias(counts.start),
        *[F.col(f"key.f{i + 1}").alias(name) for i, name in enumerate(counts.keys)],
        *[F.col(f"value.f{i + first}").alias(name) for i, name in enumerate(counts.values)],
    )


def _numbered(kind: StructType) -> StructType:
    """The same fields by number: those of a state may share one name."""
    return StructType([StructField(f"f{i}", field.dataType) for i, field in enumerate(kind.fields)])


def so_far(spark: SparkSession, counts: WindowedCounts, store: CountStore) -> DataFrame:
    """All windows, closed or open: the counts of all rows that have come."""
    closed = delivered(spark, counts, store)
    return _added([open_windows(spark, counts, store)] + ([closed] if closed is not None else []), counts)


def _added(parts: list[DataFrame], counts: WindowedCounts) -> DataFrame | None:
    if not parts:
        return None
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(counts.start, *counts.keys).agg(*[F.sum(c).alias(c) for c in counts.values])
