"""Incremental load of archive documents into the ``games`` table (H2).

One pass reads and parses the documents into a staged table in the shared
scratch folder.  Everything after works on that table, so documents are parsed
once and a lost executor repeats only a columnar read.  Games are appended first
and the ledger last: a run that stops in between is repeated safely, because the
games it wrote are recognised by their ids and the ledger by its endpoints.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from rookery import schemas
from rookery.functions import paths
from rookery.functions.periods import run_window
from rookery.operators import archive, keys, quality
from rookery.sources import archive as objects
from rookery.sources import tables
from rookery.sources.objects import read_listed

MALFORMED = "malformed document"


@dataclass(frozen=True)
class GameTables:
    """Names of the target tables."""

    games: str
    ledger: str
    rejects: str

    @classmethod
    def create(cls, spark: SparkSession, database: str, location: str | None = None) -> GameTables:
        """Create the database and the tables where absent."""
        tables.ensure_database(spark, database, location)
        names = cls(f"{database}.games", f"{database}.loading_completed", f"{database}.load_rejects")
        tables.ensure_table(spark, names.games, schemas.GAMES, "game_date")
        tables.ensure_table(spark, names.ledger, schemas.LOAD_LEDGER, "gcs_game_month")
        tables.ensure_table(spark, names.rejects, schemas.LOAD_REJECTS, "rejected_date")
        # A table made before these were kept.
        held = spark.table(names.rejects).columns
        for name, kind in (("part", "STRING"), ("text_hash", "STRING"), ("game_month", "DATE")):
            if name not in held:
                spark.sql(f"ALTER TABLE {names.rejects} ADD COLUMNS ({name} {kind})")
        return names


@dataclass(frozen=True)
class LoadResult:
    """What a run found: new games, endpoint actions, objects to purge, bad rows, counts.

    ``counts`` has rows, filtered_away, duplicates_removed and kept (D9); ``days`` are the days of the games
    table that were read.
    """

    games: DataFrame
    actions: DataFrame
    purge: DataFrame
    rejects: DataFrame
    counts: Row
    days: list[dt.date]


def on_days(column: str, days: DataFrame) -> Column:
    """Filter of a partition column to the dates in the one column of ``days``.

    The dates are listed, so a stray one adds one partition.  They are partitions of the
    table: at most one for each calendar day comes to the driver.
    """
    return F.col(column).isin([r[0] for r in days.distinct().collect()])


def pending_documents(documents: DataFrame, ledger: DataFrame) -> DataFrame:
    """Documents whose endpoint is not in the ledger yet.

    Only the ledger's partitions of the documents' months are read.
    """
    months = documents.select(paths.endpoint_month(F.col("endpoint")).alias("month"))
    done = ledger.where(on_days("gcs_game_month", months)).select(F.col("gcs_endpoint").alias("endpoint"))
    return documents.join(done.distinct(), "endpoint", "left_anti")


def load_documents(
    documents: DataFrame,
    target: GameTables,
    run_time: dt.datetime,
    mode: str = "PROD",
    strict: bool = True,
    test_volume: int = 2,
    dev_endpoint: str | None = None,
    by_endpoint: bool = True,
) -> LoadResult:
    """Load documents ``endpoint, [part,] body`` that were not handled before.

    Only ``PROD`` runs write to the tables; a ``DEV`` run reads its endpoint
    whether or not it was handled.  ``strict`` makes a malformed document, a bad
    game id or a missing required value fail the run before anything is written;
    otherwise such rows are returned and kept in the rejects table, each text of a
    place once, and a malformed document stays unhandled.  ``run_time`` marks the rows of the run.
    Without ``by_endpoint`` the ledger drops no document: where the documents of one endpoint
    come bit by bit, game ids alone decide.
    """
    if mode != "DEV" and by_endpoint:
        documents = pending_documents(documents, tables.current(documents.sparkSession, target.ledger))
    if mode != "PROD":
        names = documents.select("endpoint").distinct()
        chosen = keys.select_endpoints(names, mode, test_volume, dev_endpoint)
        documents = documents.join(chosen, "endpoint", "left_semi")
    return _load(documents, target, run_time, mode == "PROD", strict)


def _load(documents: DataFrame, target: GameTables, run_time: dt.datetime, write: bool, strict: bool) -> LoadResult:
    """Load documents known to be unhandled."""
    exploded = archive.explode_games(archive.parse_documents(documents, strict), keep_empty=True)
    return store_rows(game_rows(exploded, run_time, strict), target, run_time, write, strict)


def game_rows(exploded: DataFrame, run_time: dt.datetime, strict: bool) -> DataFrame:
    """Rows of the games table with their place; documents without games keep a row without position.

    If not ``strict``, bad rows have a ``reason`` and their ``text``.
    """
    if strict:
        return archive.games_rows(exploded, run_time, strict, keep_empty=True)
    exploded = exploded.withColumn("text", F.to_json("game"))
    rows = archive.games_rows(exploded, run_time, strict, keep_empty=True)
    broken = F.col("pos").isNotNull() & quality.breaks_contract(list(schemas.required_paths(schemas.GAMES)))
    corrupt = F.col(archive.CORRUPT).isNotNull() & F.col("pos").isNull()
    reason = F.when(corrupt, MALFORMED).when(broken, "missing required value")
    text = F.when(corrupt, F.col(archive.CORRUPT)).when(broken, F.col("text"))
    return rows.withColumns({"reason": reason, "text": text}).drop(archive.CORRUPT)


def store_rows(rows: DataFrame, target: GameTables, run_time: dt.datetime, write: bool, strict: bool) -> LoadResult:
    """Stage rows, and load the games among them that the table lacks.

    The contract, the days and months of the batch and the number of bad rows are measured while
    the rows are staged, the counts of copies while the new games are: none is a job of its own.
    """
    spark = rows.sparkSession
    has_game = F.col("pos").isNotNull()
    good = has_game if strict else has_game & F.col("reason").isNull()
    metrics = {
        "days": F.collect_set(F.when(good, F.col("game_date"))),
        "months": F.collect_set(paths.endpoint_month(F.col("endpoint"))),
        "rejects": F.lit(0) if strict else F.count("reason"),
    }
    required = list(schemas.required_paths(schemas.GAMES)) if strict else []
    # Game columns only: the bodies and move texts end here.
    nulls = quality.null_counts(required, has_game)
    staged, found = tables.stage_measured(rows, "staged", metrics | nulls)
    quality.refuse({path: found[path] for path in required})
    if strict:
        rejects = spark.createDataFrame([], schemas.LOAD_REJECTS)
    else:
        rejects = _rejected(staged, run_time)
        staged = staged.where(F.coalesce(F.col("reason") != MALFORMED, F.lit(True)))
    actions = archive.action_ledger(staged, run_time)
    batch = staged.where(good).drop("reason", "text", "has_games")

    # A game's date follows from its own end time, so an earlier copy of a game
    # lies on the same day and the other partitions need not be read.
    days = sorted(found["days"])
    known = tables.current(spark, target.games).where(F.col("game_date").isin(days)).select("game_id")
    marked = first_copies(batch).join(known.distinct().withColumn("is_known", F.lit(True)), "game_id", "left")
    is_known = F.col("is_known").isNotNull()
    fresh, counts = _staged_fresh(marked, is_known)
    if write:
        same_months = F.col("gcs_game_month").isin(found["months"])
        seen = tables.current(spark, target.ledger).where(same_months)
        seen = seen.select(F.col("gcs_endpoint").alias("_endpoint"), F.col("action_taken").alias("_action"))
        # An endpoint whose earlier documents were empty gets a second row when games come; a loaded one none.
        settled = (F.col("_action") == archive.LOADED) | (F.col("_action") == F.col("action_taken"))
        new_actions = actions.join(seen, (F.col("gcs_endpoint") == F.col("_endpoint")) & settled, "left_anti")
        actions = tables.stage(new_actions, "actions")
        if counts["kept"]:
            tables.append(fresh, target.games, "game_date")
        if found["rejects"]:
            tables.append(_unstored(rejects, target, found["months"]), target.rejects, "rejected_date")
        tables.append(actions, target.ledger, "gcs_game_month")
    return LoadResult(fresh, actions, archive.purge_list(actions), rejects, Row(**counts), days)


def _staged_fresh(marked: DataFrame, is_known: Column) -> tuple[DataFrame, dict[str, int]]:
    """The games that are not known, staged, and the counts of all."""
    counts = keys.copy_counts(is_known)
    seen = Observation()
    observed = marked.observe(seen, *[column.alias(name) for name, column in counts.items()])
    fresh = tables.stage(observed.where(~is_known).select(*schemas.GAMES.fieldNames()), "fresh")
    return fresh, {name: seen.get[name] for name in counts}


def _rejected(staged: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Bad rows as rows of the rejects table."""
    stamp = F.lit(run_time).cast("timestamp")
    part = F.col("part") if "part" in staged.columns else F.lit(None)
    columns = {
        "part": part.cast("string"),
        "text_hash": F.sha2("text", 256),
        "game_month": paths.endpoint_month(F.col("endpoint")),
        "rejected_dt": stamp,
        "rejected_date": F.to_date(stamp),
    }
    names = schemas.LOAD_REJECTS.fieldNames()
    return staged.where("reason IS NOT NULL").select(*[columns.get(n, F.col(n)).alias(n) for n in names])


def _unstored(rejects: DataFrame, target: GameTables, months: list[dt.date]) -> DataFrame:
    """Rejects the table lacks: a run that is repeated, or meets a text again in its place, adds no second row.

    Stored texts are told apart by their hash; only rows of the batch's months are compared.
    """
    same = ("endpoint", "part", "pos", "reason", "text_hash")
    stored = tables.current(rejects.sparkSession, target.rejects)
    # Rows of before have neither hash nor month.
    stored = stored.where(F.col("game_month").isin(months) | F.col("game_month").isNull())
    stored = stored.withColumn("text_hash", F.coalesce("text_hash", F.sha2("text", 256)))
    had = stored.select(*[F.col(c).alias(f"_{c}") for c in same]).distinct()
    return rejects.join(had, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same], "left_anti")


def _place(batch: DataFrame) -> list[str]:
    return [c for c in ("endpoint", "part", "pos") if c in batch.columns]


def first_copies(batch: DataFrame) -> DataFrame:
    """First copy of each game of the batch, with the number of copies."""
    return keys.first_and_copies(batch, "game_id", _place(batch))


def new_games(batch: DataFrame, table: DataFrame) -> DataFrame:
    """First copy of each game of the batch that the table lacks.

    De-duplicating first lets copies collapse before the shuffle and leaves the
    batch partitioned by game for the anti-join: one exchange serves both.
    """
    unique = keys.keep_first(batch, "game_id", _place(batch))
    return unique.join(table.select("game_id"), "game_id", "left_anti").select(*schemas.GAMES.fieldNames())


def load_month(
    spark: SparkSession,
    root: str,
    period: str,
    target: GameTables,
    run_time: dt.datetime,
    mode: str = "PROD",
    strict: bool = True,
    test_volume: int = 2,
    dev_endpoint: str | None = None,
) -> LoadResult:
    """Load the objects of one period (H2).

    Objects are listed with their sizes; handled ones are dropped from the list, and only the rest is
    opened.  A ``DEV`` run opens ``dev_endpoint`` alone.
    """
    if mode == "DEV":
        if not dev_endpoint:
            raise ValueError("a DEV run needs dev_endpoint")
        return _load(objects.read_objects(spark, root, period, dev_endpoint), target, run_time, False, strict)
    month = F.to_date(F.lit(f"{period}/01"), "yyyy/MM/dd")
    done = tables.current(spark, target.ledger).where(F.col("gcs_game_month") == month)
    listed = objects.list_objects(spark, root, period)
    todo = listed.join(done.select(F.col("gcs_endpoint").alias("path")).distinct(), "path", "left_anti")
    if mode != "PROD":
        chosen = keys.select_endpoints(todo.select(F.col("path").alias("endpoint")), mode, test_volume)
        todo = todo.join(chosen.select(F.col("endpoint").alias("path")), "path", "left_semi")
    return _load(read_listed(todo, root), target, run_time, mode == "PROD", strict)


def run_period(spark: SparkSession, as_of: dt.date, mode: str, start: dt.date | None = None) -> str:
    """Period a run loads: that of the month before ``as_of`` in ``PROD``, else that of ``start``."""
    day = F.lit(start) if start else None
    return spark.range(1).select(run_window(F.lit(as_of), mode, day, day)["period"]).first()[0]


def load_run(
    spark: SparkSession,
    root: str,
    as_of: dt.date,
    target: GameTables,
    run_time: dt.datetime,
    mode: str = "PROD",
    start: dt.date | None = None,
    **options: object,
) -> LoadResult:
    """:func:`load_month` of the period that the mode and the day of the run give."""
    return load_month(spark, root, run_period(spark, as_of, mode, start), target, run_time, mode, **options)
