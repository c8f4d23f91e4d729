"""Request planning and membership tests on the given tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from rookery.bindings.views import (
    BASE_URL,
    GRID_END,
    GRID_START,
    RUN_TIME,
    V_ARCHIVE,
    V_GRID,
    boards,
    documents,
    landed,
    players,
    request_ledger,
    table,
    with_cte,
)
from rookery.functions import games, paths
from rookery.operators import archive
from rookery.operators import keys as ops
from rookery.plans.ingest import RequestTables, ingest_window, record_outcomes, store_requests
from rookery.plans.ingest import plan_requests as plan
from rookery.session import scratch_path
from rookery.sources.archive import append_leaderboards, write_leaderboards
from rookery.sources.objects import list_objects, write_objects
from rookery.sources.tables import stage

TEST_VOLUME = 25
CYCLE_AS_OF = dt.date(2001, 1, 20)


def endpoint_listing(spark, sf_dir):
    """Landed endpoints of one month among all objects, leaderboard snapshots included."""
    objects = landed(spark, sf_dir).distinct().select(F.col("endpoint").alias("path"))
    snapshots = objects.select(F.regexp_replace("path", "^player/", "leaderboards/").alias("path"))
    return ops.list_endpoints(objects.union(snapshots), "1997/04")


def leaderboard_players(spark, sf_dir):
    return archive.leaderboard_players(boards(spark, sf_dir))


def endpoint_parts(spark, sf_dir):
    """December URLs name no player."""
    url = paths.request_url(F.col("endpoint"), BASE_URL)
    broken = F.when(F.col("endpoint").endswith("/12"), F.lit(BASE_URL + "leaderboards")).otherwise(url)
    urls = landed(spark, sf_dir).distinct().select("endpoint", broken.alias("url"))
    return urls.select(
        "endpoint", paths.player_of(F.col("url")).alias("player"), paths.period_of(F.col("url")).alias("period")
    )


def request_grid(spark, sf_dir):
    return ops.request_grid(players(spark, sf_dir), GRID_START, GRID_END)


def _remaining(spark, sf_dir, done):
    return ops.remaining_requests(players(spark, sf_dir), GRID_START, GRID_END, done)


def remaining_endpoints(spark, sf_dir):
    return _remaining(spark, sf_dir, ops.landed_periods(landed(spark, sf_dir))).orderBy("endpoint")


def remaining_by_ledger(spark, sf_dir):
    return _remaining(spark, sf_dir, ops.ledger_periods(request_ledger(spark, sf_dir), skip_failed=True))


def remaining_by_ledger_retry(spark, sf_dir):
    return _remaining(spark, sf_dir, ops.ledger_periods(request_ledger(spark, sf_dir), skip_failed=False))


def coverage_counts(spark, sf_dir):
    done = ops.landed_periods(landed(spark, sf_dir))
    return ops.coverage_counts(players(spark, sf_dir), GRID_START, GRID_END, done)


def ingest_cycle(spark, sf_dir):
    """Plan from the stored leaderboards, record the outcome of every other request, plan again: the remainder.

    Half of the outcomes are failures, which are tried again.
    """
    database = f"rookery_ingest_{uuid.uuid4().hex}"
    target = RequestTables.create(spark, database, scratch_path(spark, "ingest"))
    location = scratch_path(spark, "boards")
    write_leaderboards(boards(spark, sf_dir), location, RUN_TIME)
    window = ingest_window(spark, CYCLE_AS_OF, "PROD")
    number = F.substring_index("player", "#", -1).cast("int")
    outcome = F.when(number % 4 == 0, "failed").otherwise("fetched")
    made = store_requests(spark, location, target, window, BASE_URL).where(number % 2 == 0)
    record_outcomes(made.withColumn("outcome", outcome), target)
    again = stage(store_requests(spark, location, target, window, BASE_URL, skip_failed=False), "result")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return again


def request_urls(spark, sf_dir):
    return landed(spark, sf_dir).distinct().select(
        "endpoint", paths.request_url(F.col("endpoint"), BASE_URL).alias("url")
    )


def path_prefix_add(spark, sf_dir):
    """Some players' folders are excluded from the move."""
    moved = paths.add_prefix(F.col("endpoint"), "raw", ["player/customer#000000001", "player/customer#000000007"])
    return landed(spark, sf_dir).distinct().select("endpoint", moved.alias("moved"))


def path_prefix_rename(spark, sf_dir):
    """Paths that repeat the prefix further on lose only the first."""
    path = F.when(
        F.col("endpoint").endswith("/01"), F.concat(F.lit("player/"), F.col("endpoint"))
    ).otherwise(F.col("endpoint"))
    listed = landed(spark, sf_dir).distinct().select(path.alias("path"))
    return listed.select("path", paths.rename_prefix(F.col("path"), "player", "gamer").alias("renamed"))


def endpoint_mode_select(spark, sf_dir):
    return ops.select_endpoints(landed(spark, sf_dir).distinct(), "TEST", TEST_VOLUME)


def set_difference(spark, sf_dir):
    """Customers (unknown for one segment) without any open order."""
    known = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("custkey")
    )
    active = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("custkey"))
    return ops.set_difference(known, active)


def _archive_ids(spark, sf_dir):
    exploded = archive.explode_games(archive.parse_documents(documents(spark, sf_dir)))
    return exploded.select("endpoint", "part", "pos", games.game_id(F.col("game.url")).alias("game_id"))


def _loaded_ids(spark, sf_dir):
    """Games before 1998 count as loaded already, once per line item."""
    orders = table(spark, sf_dir, "orders").where("o_orderdate < '1998-01-01'")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(F.col("o_orderkey").alias("game_id"))


def missing_keys(spark, sf_dir):
    return ops.missing_keys(_archive_ids(spark, sf_dir), _loaded_ids(spark, sf_dir), "game_id")


def semi_join_missing(spark, sf_dir):
    rows = _archive_ids(spark, sf_dir)
    return ops.rows_missing(rows, _loaded_ids(spark, sf_dir), "game_id")


def batch_counts(spark, sf_dir):
    return ops.batch_counts(_archive_ids(spark, sf_dir), _loaded_ids(spark, sf_dir))


def leaderboard_snapshots(spark, sf_dir):
    """Two dated snapshots, of which the first lacks a segment: players, and those the second brought."""
    location = scratch_path(spark, "snapshots")
    every = boards(spark, sf_dir)
    append_leaderboards(every.where("NOT contains(body, 'MACHINERY')"), location, RUN_TIME)
    append_leaderboards(every, location, RUN_TIME + dt.timedelta(days=31))
    return archive.snapshot_players(spark.read.parquet(location))


def plan_from_storage(spark, sf_dir):
    """Requests of a year that no stored object answers: objects of all periods are listed from storage."""
    root = scratch_path(spark, "stored")
    stored = landed(spark, sf_dir).where("endpoint LIKE '%/1997/0%'").distinct()
    write_objects(stored.select("endpoint", F.lit("{}").alias("body")), root)
    listed = list_objects(spark, root).select(F.col("path").alias("endpoint"))
    return plan(boards(spark, sf_dir), dt.date(1997, 1, 1), dt.date(1997, 12, 1), BASE_URL, landed=listed)


def plan_requests(spark, sf_dir):
    return plan(boards(spark, sf_dir), GRID_START, GRID_END, BASE_URL, landed=landed(spark, sf_dir))


QUERIES = {
    "leaderboard_snapshots": leaderboard_snapshots,
    "plan_from_storage": plan_from_storage,
    "endpoint_listing": endpoint_listing,
    "leaderboard_players": leaderboard_players,
    "endpoint_parts": endpoint_parts,
    "request_grid": request_grid,
    "remaining_endpoints": remaining_endpoints,
    "remaining_by_ledger": remaining_by_ledger,
    "remaining_by_ledger_retry": remaining_by_ledger_retry,
    "coverage_counts": coverage_counts,
    "ingest_cycle": ingest_cycle,
    "request_urls": request_urls,
    "path_prefix_add": path_prefix_add,
    "path_prefix_rename": path_prefix_rename,
    "endpoint_mode_select": endpoint_mode_select,
    "set_difference": set_difference,
    "missing_keys": missing_keys,
    "semi_join_missing": semi_join_missing,
    "batch_counts": batch_counts,
    "plan_requests": plan_requests,
}

_LOADED = """v_loaded AS (
  SELECT o_orderkey AS game_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < DATE '1998-01-01'
)"""

ORACLE = {
    "leaderboard_snapshots": """SELECT DATE '2025-01-20' AS snapshot_date, lower(c_name) AS player, true AS is_new
FROM customer WHERE c_mktsegment <> 'MACHINERY'
UNION ALL SELECT DATE '2025-02-20', lower(c_name), c_mktsegment = 'MACHINERY' FROM customer""",
    "plan_from_storage": with_cte(V_GRID)
    + """SELECT player, period, endpoint, 'https://x/pub/' || endpoint AS url FROM v_grid
WHERE period BETWEEN '1997/01' AND '1997/12' AND NOT (period < '1997/10' AND endpoint IN (SELECT endpoint FROM v_landed))""",
    "endpoint_listing": with_cte(V_GRID)
    + "SELECT DISTINCT endpoint FROM v_landed WHERE endpoint LIKE '%1997/04' ORDER BY endpoint",
    "leaderboard_players": "SELECT DISTINCT lower(c_name) AS player FROM customer",
    "endpoint_parts": with_cte(V_GRID)
    + """SELECT DISTINCT 'player/' || player || '/games/' || period AS endpoint,
  CASE WHEN period NOT LIKE '%/12' THEN player END AS player,
  CASE WHEN period NOT LIKE '%/12' THEN period END AS period FROM v_ledger""",
    "request_grid": with_cte(V_GRID) + "SELECT * FROM v_grid",
    "remaining_endpoints": with_cte(V_GRID)
    + "SELECT * FROM v_grid WHERE endpoint NOT IN (SELECT endpoint FROM v_landed) ORDER BY endpoint",
    "remaining_by_ledger": with_cte(V_GRID)
    + "SELECT * FROM v_grid WHERE (player, period) NOT IN (SELECT (player, period) FROM v_ledger)",
    "remaining_by_ledger_retry": with_cte(V_GRID)
    + "SELECT * FROM v_grid WHERE (player, period) NOT IN (SELECT (player, period) FROM v_ledger WHERE outcome = 'fetched')",
    "coverage_counts": with_cte(V_GRID)
    + """SELECT count(*) AS total, count(*) FILTER (endpoint IN (SELECT endpoint FROM v_landed)) AS already_done,
  count(*) FILTER (endpoint NOT IN (SELECT endpoint FROM v_landed)) AS remaining FROM v_grid""",
    "ingest_cycle": """SELECT player, endpoint, 'https://x/pub/' || endpoint AS url, period FROM (
  SELECT DISTINCT lower(c_name) AS player, '2000/12' AS period,
    'player/' || lower(c_name) || '/games/2000/12' AS endpoint FROM customer
  WHERE c_custkey % 2 = 1 OR c_custkey % 4 = 0)""",
    "request_urls": with_cte(V_GRID) + "SELECT DISTINCT endpoint, 'https://x/pub/' || endpoint AS url FROM v_landed",
    "path_prefix_add": with_cte(V_GRID)
    + """SELECT DISTINCT endpoint, CASE WHEN starts_with(endpoint, 'player/customer#000000001/')
    OR starts_with(endpoint, 'player/customer#000000007/') THEN endpoint ELSE 'raw/' || endpoint END AS moved FROM v_landed""",
    "path_prefix_rename": with_cte(V_GRID)
    + """SELECT DISTINCT CASE WHEN endpoint LIKE '%/01' THEN 'player/' ELSE '' END || endpoint AS path,
  CASE WHEN endpoint LIKE '%/01' THEN 'gamer/' || endpoint ELSE 'gamer' || substr(endpoint, 7) END AS renamed FROM v_landed""",
    "endpoint_mode_select": with_cte(V_GRID) + f"SELECT DISTINCT endpoint FROM v_landed ORDER BY endpoint LIMIT {TEST_VOLUME}",
    "set_difference": """SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS custkey FROM customer
EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""",
    "missing_keys": with_cte(V_ARCHIVE, _LOADED)
    + "SELECT DISTINCT game_id FROM v_copies WHERE game_id NOT IN (SELECT game_id FROM v_loaded)",
    "semi_join_missing": with_cte(V_ARCHIVE, _LOADED)
    + """SELECT endpoint, part, CAST(pos AS INTEGER) AS pos, game_id FROM v_copies
WHERE game_id NOT IN (SELECT game_id FROM v_loaded)""",
    "batch_counts": with_cte(V_ARCHIVE, _LOADED)
    + """SELECT count(*) AS rows, count(*) FILTER (game_id IN (SELECT game_id FROM v_loaded)) AS filtered_away,
  count(*) FILTER (game_id NOT IN (SELECT game_id FROM v_loaded))
    - count(DISTINCT game_id) FILTER (game_id NOT IN (SELECT game_id FROM v_loaded)) AS duplicates_removed,
  count(DISTINCT game_id) FILTER (game_id NOT IN (SELECT game_id FROM v_loaded)) AS kept FROM v_copies""",
    "plan_requests": with_cte(V_GRID)
    + """SELECT player, period, endpoint, 'https://x/pub/' || endpoint AS url FROM v_grid
WHERE endpoint NOT IN (SELECT endpoint FROM v_landed)""",
}
