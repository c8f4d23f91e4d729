"""The engine's inputs derived from the given tables, as DataFrames and as SQL.

Each view exists twice: a function returning a DataFrame, and a constant with
the same rows as a common table expression.  All are row-local or plain joins
and aggregates, so they grow with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.functions import paths, periods
from rookery.operators.openings import build_weekly_openings

RUN_TIME = dt.datetime(2025, 1, 20, 12, 0, 0)
GRID_START = dt.date(1995, 1, 1)
GRID_END = dt.date(2001, 9, 1)
USAGE_AS_OF = dt.date(2024, 1, 31)
BASE_URL = "https://x/pub/"

# The quarter the archive's games end in: epoch second of its start, and its days.
ARCHIVE_START = 1727740800
ARCHIVE_DAYS = 92


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_cte(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def plain(*columns: str) -> list[Column]:
    """Timestamps without a zone, so that every client prints the same text."""
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in columns]


# --- weekly openings ------------------------------------------------------------


def weekly_games(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One game per line item: date, time class, opening and both results; of the weeks in a range if given.

    The ship date is a timestamp, so the range of days is put on it, not on the date made from it.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    if start and end:
        after = dt.date.fromisoformat(end) + dt.timedelta(days=7)
        first, last = (F.lit(d).cast("date").cast(lines.schema["l_shipdate"].dataType) for d in (start, after))
        lines = lines.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < last))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status = F.col("o_orderstatus")

    def side(wins: str) -> Column:
        return F.struct(F.when(status == wins, "win").otherwise("other").alias("result"))

    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .select(
            F.to_date("l_shipdate").alias("game_date"),
            F.col("o_orderpriority").alias("time_class"),
            F.nullif("p_brand", F.lit("Brand#1")).alias("opening"),
            side("F").alias("white"),
            side("O").alias("black"),
        )
    )


def weekly(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Weekly openings of :func:`weekly_games`, of the weeks in a range if given."""
    return build_weekly_openings(weekly_games(spark, sf_dir, start, end), start=start, end=end)


V_WEEKLY = """v_weekly AS (
  SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start,
         o_orderpriority AS time_class,
         nullif(p_brand, 'Brand#1') AS opening_archetype,
         CAST(count(*) AS BIGINT) AS total_games,
         CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS white_win_count,
         CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS black_win_count
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  GROUP BY ALL
)"""


# --- job log --------------------------------------------------------------------


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One warehouse job per event; user 0 is unknown."""
    events = table(spark, sf_dir, "events")
    start = F.col("ts").cast("timestamp")
    run_ms = F.floor(F.col("value") * 1000)
    size = F.floor(F.col("value") * 1e9)
    return events.select(
        start.alias("creation_time"),
        F.concat(F.lit("project-"), "event_type").alias("project_id"),
        F.concat(F.lit("user"), F.nullif("user_id", F.lit(0)).cast("string"), F.lit("@example.com")).alias("user_email"),
        F.col("event_id").cast("string").alias("job_id"),
        start.alias("start_time"),
        F.timestamp_add("MILLISECOND", run_ms, start).alias("end_time"),
        F.col("event_type").alias("job_type"),
        F.lit("SELECT").alias("statement_type"),
        F.lit("INTERACTIVE").alias("priority"),
        (F.col("value") < 1).alias("cache_hit"),
        (F.get_json_object("props", "$.k").cast("bigint") * 1000).alias("total_slot_ms"),
        size.alias("total_bytes_processed"),
        size.alias("total_bytes_billed"),
    )


V_JOBS = """v_jobs AS (
  SELECT ts AS creation_time,
         'project-' || event_type AS project_id,
         'user' || nullif(user_id, 0) || '@example.com' AS user_email,
         CAST(event_id AS VARCHAR) AS job_id,
         ts AS start_time,
         ts + to_milliseconds(CAST(floor(value * 1000) AS BIGINT)) AS end_time,
         event_type AS job_type, 'SELECT' AS statement_type, 'INTERACTIVE' AS priority,
         value < 1 AS cache_hit,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS total_slot_ms,
         CAST(floor(value * 1e9) AS BIGINT) AS total_bytes_processed,
         CAST(floor(value * 1e9) AS BIGINT) AS total_bytes_billed
  FROM events
)"""

V_FACTS = (
    V_JOBS
    + """, v_facts AS (
  SELECT *, creation_time AS job_creation_dt,
         CAST(creation_time AS DATE) AS job_created_date,
         CAST(date_trunc('month', creation_time) AS DATE) AS job_created_month,
         date_diff('millisecond', start_time, end_time) AS total_query_ms,
         date_diff('millisecond', start_time, end_time) * CAST(0.001 AS DOUBLE) AS total_query_seconds,
         total_slot_ms * CAST(0.001 AS DOUBLE) AS total_slot_seconds,
         total_bytes_processed / 1e6 AS total_megabytes_processed,
         total_bytes_processed / 1e9 AS total_gigabytes_processed,
         total_bytes_billed / 1e6 AS total_megabytes_billed,
         total_bytes_billed / 1e9 AS total_gigabytes_billed,
         total_bytes_billed / 1e12 * CAST(6.25 AS DOUBLE) AS query_cost_usd
  FROM v_jobs
), v_user_day AS (
  SELECT project_id, job_created_date, user_email,
         count(*) AS number_of_queries,
         sum(total_query_seconds) AS total_query_seconds,
         sum(total_slot_seconds) AS total_slot_seconds,
         sum(total_gigabytes_processed) AS total_gigabytes_processed,
         sum(total_gigabytes_billed) AS total_gigabytes_billed,
         sum(query_cost_usd) AS total_query_cost_usd
  FROM v_facts GROUP BY ALL
)"""
)


# --- request grid ---------------------------------------------------------------


def _player(number: Column) -> Column:
    return F.concat(F.lit("customer#"), F.lpad(number.cast("string"), 9, "0"))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.lower("c_name").alias("player"))


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints with at least one order, one row per order."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(paths.endpoint(_player(F.col("o_custkey")), periods.period(F.col("o_orderdate"))).alias("endpoint"))


def request_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per order; pending orders count as failed fetches."""
    return table(spark, sf_dir, "orders").select(
        _player(F.col("o_custkey")).alias("player"),
        periods.period(F.col("o_orderdate")).alias("period"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("fetched").alias("outcome"),
    )


V_GRID = """v_players AS (
  SELECT lower(c_name) AS player FROM customer
), v_months AS (
  SELECT strftime(m, '%Y/%m') AS period
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-09-01', INTERVAL 1 MONTH)) AS m)
), v_grid AS (
  SELECT player, period, 'player/' || player || '/games/' || period AS endpoint FROM v_players, v_months
), v_ledger AS (
  SELECT 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS player,
         strftime(o_orderdate, '%Y/%m') AS period,
         CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'fetched' END AS outcome
  FROM orders
), v_landed AS (
  SELECT 'player/' || player || '/games/' || period AS endpoint FROM v_ledger
)"""


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaderboard documents: each customer in two formats, and a fetch time."""
    user = F.array(F.struct(F.col("c_name").alias("username")))
    shout = F.array(F.struct(F.upper("c_name").alias("username")))
    lists = F.to_json(F.create_map(F.col("c_mktsegment"), user, F.lit("daily"), shout))
    body = F.regexp_replace(lists, r"\}$", ',"_fetched_at":"2025-01-20"}')
    return table(spark, sf_dir, "customer").select(body.alias("body"))


# --- archive documents ------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = ("own", "opponent")) -> DataFrame:
    """Archive documents, two per order: endpoint, part, body.

    Games end within one quarter, spread evenly.  The player's own document holds
    the order's game, twice for pending orders.
    The opponent's document holds a copy of it for open orders, no games for
    finished ones, and no ``games`` key for pending ones.
    """
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    key, cust, status, priority = (
        F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    )
    rating = F.floor(F.col("o_totalprice") / 100)
    line = F.pmod(key, F.lit(25)).cast("string")
    number = key.cast("string")
    end_time = F.lit(ARCHIVE_START) + F.pmod(key * 7919, F.lit(ARCHIVE_DAYS * 86400))

    def side(who: Column, result: Column) -> Column:
        return F.struct(
            F.concat(F.lit("id-"), who.cast("string")).alias("uuid"),
            _player(who).alias("username"),
            rating.alias("rating"),
            result.alias("result"),
        )

    game = F.struct(
        F.concat(F.lit("https://x/game/live/"), number).alias("url"),
        end_time.alias("end_time"),
        F.lit("600").alias("time_control"),
        (status != "P").alias("rated"),
        priority.alias("time_class"),
        F.lit("chess").alias("rules"),
        side(cust, F.when(status == "F", "win").when(status == "O", "resigned").otherwise("agreed")).alias("white"),
        side(cust + 1, F.when(status == "F", "timeout").when(status == "O", "win").otherwise("agreed")).alias("black"),
        F.when(status != "P", F.struct((F.pmod(key, F.lit(50)) + 50.5).alias("white"), F.lit(71.25).alias("black"))).alias(
            "accuracies"
        ),
        F.when(
            priority.isin("1-URGENT", "2-HIGH"), F.concat(F.lit("https://x/openings/Given-Line-"), line)
        ).alias("eco"),
        F.when(
            priority == "3-MEDIUM",
            F.concat(F.lit('[Event "Live"]\n[ECOUrl "https://x/openings/Tagged-Line-'), line, F.lit('"]\n\n1. e4 e5')),
        )
        .when(priority == "4-NOT SPECIFIED", F.lit('[Event "Live"]\n\n1. d4 d5'))
        .alias("pgn"),
    )
    month = periods.period(F.timestamp_seconds(end_time))
    # The game is written as text once, and the documents are made of that text.
    orders = orders.select("*", F.explode(F.array(F.to_json(game))).alias("text"))
    one, two = (F.concat(F.lit('{"games":['), F.array_join(F.array(*["text"] * n), ","), F.lit("]}")) for n in (1, 2))
    body = {
        "own": F.when(status == "P", two).otherwise(one),
        "opponent": F.when(status == "O", one)
        .when(status == "F", F.lit('{"games": []}'))
        .otherwise(F.lit("{}")),
    }
    who = {"own": cust, "opponent": cust + 1}
    docs = F.array(
        *[
            F.struct(
                paths.endpoint(_player(who[k]), month).alias("endpoint"),
                key.alias("part"),
                body[k].alias("body"),
            )
            for k in kinds
        ]
    )
    return orders.select(F.inline(docs))


V_ARCHIVE = f"""v_orders AS (
  SELECT *, {ARCHIVE_START} + (o_orderkey * 7919) % ({ARCHIVE_DAYS} * 86400) AS end_time FROM orders
), v_games AS (
  SELECT o_orderkey AS game_id,
         'https://x/game/live/' || o_orderkey AS url,
         end_time,
         CAST(TIMESTAMP '1970-01-01' + to_seconds(end_time) AS DATE) AS game_date,
         TIMESTAMP '2025-01-20 12:00:00' AS ingested_dt,
         '600' AS time_control, o_orderstatus <> 'P' AS rated, o_orderpriority AS time_class, 'chess' AS rules,
         'id-' || o_custkey AS white_uuid,
         'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS white_username,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS white_rating,
         CASE o_orderstatus WHEN 'F' THEN 'win' WHEN 'O' THEN 'resigned' ELSE 'agreed' END AS white_result,
         'id-' || (o_custkey + 1) AS black_uuid,
         'customer#' || lpad(CAST(o_custkey + 1 AS VARCHAR), 9, '0') AS black_username,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS black_rating,
         CASE o_orderstatus WHEN 'F' THEN 'timeout' WHEN 'O' THEN 'win' ELSE 'agreed' END AS black_result,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 50 + 50.5 AS DOUBLE) END AS white_accuracy,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(71.25 AS DOUBLE) END AS black_accuracy,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'https://x/openings/Given-Line-' || (o_orderkey % 25)
              WHEN o_orderpriority = '3-MEDIUM' THEN 'https://x/openings/Tagged-Line-' || (o_orderkey % 25)
              ELSE 'ECO Not Found' END AS eco,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Given Line ' || (o_orderkey % 25)
              WHEN o_orderpriority = '3-MEDIUM' THEN 'Tagged Line ' || (o_orderkey % 25)
              ELSE 'ECO Not Found' END AS opening,
         o_orderstatus AS status,
         strftime(TIMESTAMP '1970-01-01' + to_seconds(end_time), '%Y/%m') AS period
  FROM v_orders
), v_copies AS (
  SELECT 'player/' || white_username || '/games/' || period AS endpoint, game_id AS part, 0 AS pos, * FROM v_games
  UNION ALL
  SELECT 'player/' || white_username || '/games/' || period, game_id, 1, * FROM v_games WHERE status = 'P'
  UNION ALL
  SELECT 'player/' || black_username || '/games/' || period, game_id, 0, * FROM v_games WHERE status = 'O'
), v_actions AS (
  SELECT endpoint AS gcs_endpoint, CAST(strptime(any_value(period), '%Y/%m') AS DATE) AS gcs_game_month,
         TIMESTAMP '2025-01-20 12:00:00' AS gcs_object_interaction_dt,
         CASE WHEN bool_or(has_games) THEN 'Loaded' ELSE 'Deleted' END AS action_taken
  FROM (SELECT 'player/' || white_username || '/games/' || period AS endpoint, period, true AS has_games FROM v_games
        UNION ALL
        SELECT 'player/' || black_username || '/games/' || period, period, status = 'O' FROM v_games)
  GROUP BY endpoint
)"""

GAME_COLUMNS_SQL = """game_id, url, game_date, ingested_dt, time_control, end_time, rated, time_class, rules,
  white_uuid, white_username, white_rating, white_result, black_uuid, black_username, black_rating, black_result,
  white_accuracy, black_accuracy, eco, opening"""


def flat_games(games: DataFrame, *keep: str) -> DataFrame:
    """Games rows with their records spread over columns."""
    sides = [
        F.col(f"{s}.{f}").alias(f"{s}_{f}") for s in ("white", "black") for f in ("uuid", "username", "rating", "result")
    ]
    return games.select(
        *keep,
        "game_id",
        "url",
        "game_date",
        *plain("ingested_dt"),
        "time_control",
        "end_time",
        "rated",
        "time_class",
        "rules",
        *sides,
        F.col("accuracies.white").alias("white_accuracy"),
        F.col("accuracies.black").alias("black_accuracy"),
        "eco",
        "opening",
    )


# --- event messages ---------------------------------------------------------------


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One encoded log message and one encoded job message per event.

    Sign-ups carry no data, errors a text cut short; user 1 has an empty host
    name and purchases over 100 no zone.
    """
    kind = F.col("event_type")
    log = F.to_json(
        F.struct(
            F.concat(F.lit("logs/"), F.when(F.col("value") < 20, "system").otherwise("audit")).alias("logName"),
            F.struct(
                F.lit("vm_instance").alias("type"),
                F.struct(
                    F.when((kind != "purchase") | (F.col("value") <= 100), F.concat(F.lit("zone-"), kind)).alias("zone")
                ).alias("labels"),
            ).alias("resource"),
            F.struct(
                F.when(F.col("user_id") == 1, "").otherwise(F.concat(F.lit("host-"), "user_id")).alias("_HOSTNAME"),
                F.concat(
                    F.when(kind == "view", "Container start").otherwise("Container die"),
                    F.lit(" image=registry/worker-"),
                    "user_id",
                ).alias("MESSAGE"),
            ).alias("jsonPayload"),
        )
    )
    job = F.to_json(
        F.struct(
            F.concat(kind, F.lit("_load_"), "user_id", F.lit(".py")).alias("script_name"),
            F.concat(F.lit("job_"), kind).alias("job_name"),
            F.lit("PROD").alias("app_env"),
            F.date_format("ts", "yyyy-MM-dd").alias("start_date"),
        )
    )
    cut = F.when(kind == "error", F.left(log, F.lit(40))).otherwise(log)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind != "signup", F.base64(cut.cast("binary"))).alias("log_data"),
        F.when(kind != "signup", F.base64(job.cast("binary"))).alias("job_data"),
    )


V_MSG = """v_msg AS (
  SELECT event_id, event_type, user_id,
         event_type <> 'signup' AS has_data,
         event_type NOT IN ('signup', 'error') AS parses,
         'logs/' || CASE WHEN value < 20 THEN 'system' ELSE 'audit' END AS log_name,
         'vm_instance' AS resource_type,
         CASE WHEN event_type <> 'purchase' OR value <= 100 THEN 'zone-' || event_type END AS zone,
         CASE WHEN user_id = 1 THEN '' ELSE 'host-' || user_id END AS hostname,
         CASE WHEN event_type = 'view' THEN 'Container start' ELSE 'Container die' END
           || ' image=registry/worker-' || user_id AS message,
         event_type || '_load_' || user_id || '.py' AS script_name,
         'job_' || event_type AS job_name,
         strftime(ts, '%Y-%m-%d') AS start_date
  FROM events
)"""
