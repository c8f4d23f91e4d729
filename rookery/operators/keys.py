"""Request grid, membership tests, de-duplication and coverage.

Key sets are de-duplicated before they meet: the partial aggregate runs before
the shuffle, so many copies of one key reach the join as a single row, and the
join reuses the partitioning of the aggregate.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions import paths
from rookery.functions.periods import month_list, month_names


def list_endpoints(objects: DataFrame, period: str | None = None, path: str = "path") -> DataFrame:
    """Player endpoints among object paths, of one period if given, sorted (A2)."""
    keep = F.col(path).startswith("player/")
    if period is not None:
        keep = keep & F.col(path).endswith(period)
    return objects.where(keep).select(F.col(path).alias("endpoint")).orderBy("endpoint")


def window_months(start: Column | dt.date, end: Column | dt.date) -> Column:
    """Array of the months of a window; a constant when both dates are known."""
    if isinstance(start, Column) or isinstance(end, Column):
        return month_list(*(c if isinstance(c, Column) else F.lit(c) for c in (start, end)))
    return F.lit(month_names(start, end)).cast("array<string>")


def request_grid(players: DataFrame, start: Column | dt.date, end: Column | dt.date) -> DataFrame:
    """Every player in every month of the window: player, period, endpoint.

    The months are an array on each player's row, so no second input is joined.
    """
    grid = players.select("player", F.explode(window_months(start, end)).alias("period"))
    return grid.withColumn("endpoint", paths.endpoint(F.col("player"), F.col("period")))


def remaining_endpoints(endpoints: DataFrame, handled: DataFrame) -> DataFrame:
    """Endpoints that are not among the handled ones."""
    return endpoints.join(handled.select("endpoint").distinct(), "endpoint", "left_anti")


def landed_periods(landed: DataFrame) -> DataFrame:
    """player, period of landed endpoints; other paths have none."""
    parts = landed.select(F.explode(paths.request_parts(F.col("endpoint"))).alias("named"))
    return parts.select(
        F.split_part("named", F.lit("/"), F.lit(2)).alias("player"), F.right("named", F.lit(7)).alias("period")
    )


def ledger_periods(ledger: DataFrame, skip_failed: bool = True) -> DataFrame:
    """player, period that need no further request (D3).

    A failed fetch counts as done when ``skip_failed``; otherwise it is tried again.
    """
    done = ledger if skip_failed else ledger.where(F.col("outcome") != "failed")
    return done.select("player", "period")


def player_months(players: DataFrame, start: Column | dt.date, end: Column | dt.date, done: DataFrame) -> DataFrame:
    """player, months of the window, periods of it that are done: one row per player.

    What is done is gathered per player, at most the months of the window, and
    joined on the player: one row per player moves, not one per player and month.
    A row is kept by comparing its period with the first and the last month, as text; what
    lies between them and is no month goes once per player.
    """
    months = window_months(start, end)
    if isinstance(start, Column) or isinstance(end, Column):
        inside = done.where(F.array_contains(months, F.col("period")))
    else:
        names = month_names(start, end)
        inside = done.where(F.col("period").between(names[0], names[-1]) if names else F.lit(False))
    sets = inside.groupBy("player").agg(F.collect_set("period").alias("done"))
    rows = players.select("player", months.alias("months")).join(sets, "player", "left")
    had = F.array_intersect("months", F.coalesce("done", F.array().cast("array<string>")))
    return rows.select("player", "months", had.alias("done"))


def remaining_requests(players: DataFrame, start: Column | dt.date, end: Column | dt.date, done: DataFrame) -> DataFrame:
    """player, period, endpoint of the window that ``done`` (player, period) lacks."""
    months = player_months(players, start, end, done)
    rows = months.select("player", F.explode(F.array_except("months", "done")).alias("period"))
    return rows.withColumn("endpoint", paths.endpoint(F.col("player"), F.col("period")))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks; NULL equals NULL.

    One aggregate over both inputs: a NULL-safe anti-join would shuffle them again
    after they are made distinct.
    """
    sides = left.withColumn("in_right", F.lit(False)).union(right.withColumn("in_right", F.lit(True)))
    groups = sides.groupBy(*left.columns).agg(F.bool_or("in_right").alias("in_right"))
    return groups.where(~F.col("in_right")).select(*left.columns)


def missing_keys(local: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Distinct local keys that the table does not hold."""
    return local.select(key).distinct().join(table.select(key).distinct(), key, "left_anti")


def keep_missing(rows: DataFrame, missing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the missing ones."""
    return rows.join(missing.select(key).distinct(), key, "left_semi")


def rows_missing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key the table does not hold, in one pass over the rows."""
    return rows.join(table.select(key).distinct(), key, "left_anti")


def keep_first(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``.

    An aggregate rather than a window: copies of a key are reduced before the
    shuffle, however many there are.
    """
    others = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("first")
    return rows.groupBy(key).agg(first).select(key, "first.*").select(*rows.columns)


def first_and_copies(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """:func:`keep_first`, with the number of ``copies`` each key had."""
    others = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("first")
    return rows.groupBy(key).agg(first, F.count(F.lit(1)).alias("copies")).select(key, "first.*", "copies")


def copy_counts(known: Column) -> dict[str, Column]:
    """Rows filtered away, removed as duplicates, and kept, over one row per key with its ``copies``."""
    copies = F.col("copies")
    return {
        "rows": F.coalesce(F.sum("copies"), F.lit(0)),
        "filtered_away": F.coalesce(F.sum(F.when(known, copies)), F.lit(0)),
        "duplicates_removed": F.coalesce(F.sum(F.when(~known, copies - 1)), F.lit(0)),
        "kept": F.count_if(~known),
    }


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All batches by column name; columns a batch lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def coverage_counts(players: DataFrame, start: Column | dt.date, end: Column | dt.date, done: DataFrame) -> DataFrame:
    """Total, already done and remaining requests of the window, from the sizes of each player's sets."""
    months = player_months(players, start, end, done)
    total, had = (F.coalesce(F.sum(F.size(c).cast("long")), F.lit(0)) for c in ("months", "done"))
    return months.agg(total.alias("total"), had.alias("already_done"), (total - had).alias("remaining"))


def batch_counts(batch: DataFrame, table: DataFrame, key: str = "game_id") -> DataFrame:
    """Rows of a batch filtered away, removed as duplicates, and kept."""
    copies = batch.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    known = table.select(key).distinct().withColumn("is_known", F.lit(True))
    counts = copy_counts(F.col("is_known").isNotNull())
    return copies.join(known, key, "left").agg(*[column.alias(name) for name, column in counts.items()])


def select_endpoints(
    endpoints: DataFrame,
    mode: str,
    test_volume: int = 2,
    dev_endpoint: str | None = None,
) -> DataFrame:
    """Endpoints a run handles.

    ``PROD`` takes all, ``TEST`` the first ``test_volume`` in order, ``DEV`` the
    one named endpoint.
    """
    if mode == "PROD":
        return endpoints
    if mode == "TEST":
        return endpoints.orderBy("endpoint").limit(test_volume)
    if mode == "DEV":
        return endpoints.where(F.col("endpoint") == dev_endpoint)
    raise ValueError(f"unknown mode {mode!r}")
