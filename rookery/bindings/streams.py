"""Streaming jobs on the given tables, run over all that is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery import schemas
from rookery.bindings.archive import _kept, _location, _target, land
from rookery.bindings.messages import LOG_NAME, MESSAGE_PARTS, RESOURCE_TYPE, VALID_EVENTS_SQL
from rookery.bindings.usage import _facts
from rookery.bindings.views import (
    GAME_COLUMNS_SQL,
    RUN_TIME,
    V_ARCHIVE,
    V_FACTS,
    V_MSG,
    documents,
    flat_games,
    messages,
    with_cte,
)
from rookery.session import scratch_path
from rookery.streaming import counts, load
from rookery.streaming import messages as message_stream
from rookery.streaming.runs import file_stream, run_to_files, stream_session


def _landed(spark, sf_dir):
    location = scratch_path(spark, "landing")
    land(spark, sf_dir, location)
    return location


def _landing_stream(spark, location, max_files=None):
    return file_stream(spark, location, schemas.readable(schemas.LANDING), max_files=max_files)


def _result(spark, stream, label):
    """Output of a stream run to its end."""
    location = scratch_path(spark, label)
    run_to_files(stream, location, scratch_path(spark, f"{label}-checkpoint"))
    return spark.read.parquet(location)


def stream_messages(spark, sf_dir):
    location = scratch_path(spark, "messages")
    rows = messages(spark, sf_dir).select("event_id", F.col("log_data").alias("data"))
    rows.write.parquet(location)
    handled = message_stream.handled_events(
        file_stream(spark, location, rows.schema), LOG_NAME, RESOURCE_TYPE, MESSAGE_PARTS
    )
    return _result(spark, handled.select("event_id", "hostname", "zone", "message"), "handled")


def stream_load(spark, sf_dir):
    target = _target(spark, "stream")
    location = _landed(spark, sf_dir)
    for _ in range(2):
        # The second start finds nothing new behind the checkpoint.
        stream = _landing_stream(spark, location).select("endpoint", "body")
        load.start_load(stream, target, f"{location}-checkpoint", RUN_TIME).awaitTermination()
    return flat_games(_kept(spark, target))


def stream_dedup(spark, sf_dir):
    """Newest month first, a few files at a time: every game comes out once."""
    target, own = _target(spark, "unique"), stream_session(spark)
    location = scratch_path(spark, "landing")
    months = documents(spark, sf_dir).select(F.substring("endpoint", -8, 8).alias("month")).distinct()
    for row in sorted(months.collect(), reverse=True):
        land(spark, sf_dir, location, periods=(row["month"],))
        stream = _landing_stream(own, location, max_files=4).select("endpoint", "body")
        load.start_unique_games(stream, target, f"{location}-checkpoint", RUN_TIME).awaitTermination()
    return _kept(spark, target).select("game_id", "url", "game_date", "opening")


def _usage_counts(spark, sf_dir):
    """Facts land in three runs, the last days of a month first: most of what follows is late."""
    facts = _facts(spark, sf_dir).select(
        "job_creation_dt",
        "project_id",
        "user_email",
        "total_query_seconds",
        "total_slot_seconds",
        "total_gigabytes_processed",
        "total_gigabytes_billed",
        "query_cost_usd",
    )
    store, location = counts.CountStore(scratch_path(spark, "usage-counts")), scratch_path(spark, "facts")
    day = F.dayofmonth("job_creation_dt")
    for landed in (day > 20, day <= 10, day.between(11, 20)):
        facts.where(landed).write.mode("append").parquet(location)
        stream = file_stream(spark, location, facts.schema, max_files=2)
        counts.run_counts(stream, counts.DAILY_USAGE, store, "1 day")
    return store


def _rounded(daily):
    return daily.withColumns({c: F.round(c, 7) for c in daily.columns if c.startswith("total_")})


def stream_daily_usage(spark, sf_dir):
    """All windows: those delivered, what came late for them, and the open ones from the state."""
    return _rounded(counts.so_far(spark, counts.DAILY_USAGE, _usage_counts(spark, sf_dir)))


def stream_closed_usage(spark, sf_dir):
    """Windows that the watermark has passed, with what came late for them."""
    return _rounded(counts.delivered(spark, counts.DAILY_USAGE, _usage_counts(spark, sf_dir)))


def stream_weekly_games(spark, sf_dir):
    """Landed documents are loaded, and the games table, which grows by unseen games, is counted."""
    target = _target(spark, "weekly")
    location = _landed(spark, sf_dir)
    stream = _landing_stream(spark, location).select("endpoint", "body")
    load.start_load(stream, target, f"{location}-checkpoint", RUN_TIME).awaitTermination()
    own = file_stream(spark, _location(spark, target.games), spark.table(target.games).schema)
    timed = own.withColumn("end_dt", F.timestamp_seconds("end_time"))
    store = counts.CountStore(scratch_path(spark, "weekly-counts"))
    counts.run_counts(timed, counts.WEEKLY_GAMES, store, "7 days")
    _kept(spark, target)
    return counts.so_far(spark, counts.WEEKLY_GAMES, store)


QUERIES = {
    "stream_messages": stream_messages,
    "stream_load": stream_load,
    "stream_dedup": stream_dedup,
    "stream_daily_usage": stream_daily_usage,
    "stream_closed_usage": stream_closed_usage,
    "stream_weekly_games": stream_weekly_games,
}

DAILY_USAGE_SQL = """SELECT job_created_date, project_id, user_email, number_of_queries,
  round(total_query_seconds, 7) AS total_query_seconds, round(total_slot_seconds, 7) AS total_slot_seconds,
  round(total_gigabytes_processed, 7) AS total_gigabytes_processed,
  round(total_gigabytes_billed, 7) AS total_gigabytes_billed, round(total_query_cost_usd, 7) AS total_query_cost_usd
FROM v_user_day"""

ORACLE = {
    "stream_messages": with_cte(V_MSG) + VALID_EVENTS_SQL + " AND hostname <> '' AND zone IS NOT NULL",
    "stream_load": with_cte(V_ARCHIVE) + f"SELECT {GAME_COLUMNS_SQL} FROM v_games",
    "stream_dedup": with_cte(V_ARCHIVE) + "SELECT game_id, url, game_date, opening FROM v_games",
    "stream_daily_usage": with_cte(V_FACTS) + DAILY_USAGE_SQL,
    "stream_closed_usage": with_cte(V_FACTS)
    + DAILY_USAGE_SQL
    + "\nWHERE job_created_date + INTERVAL 1 DAY <= (SELECT max(job_creation_dt) - INTERVAL 1 DAY FROM v_facts)",
    "stream_weekly_games": with_cte(V_ARCHIVE)
    + """SELECT CAST(date_trunc('week', game_date) AS DATE) AS week_start, time_class, opening,
  count(*) AS total_games, count(*) FILTER (white_result = 'win') AS white_win_count,
  count(*) FILTER (black_result = 'win') AS black_win_count
FROM v_games GROUP BY ALL""",
}
