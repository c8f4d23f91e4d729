"""Archive documents to ``games`` rows, leaderboards to players."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from rookery import schemas
from rookery.functions import games, paths

LOADED = "Loaded"
DELETED = "Deleted"
CORRUPT = "_corrupt"


def parse_documents(documents: DataFrame, strict: bool = True) -> DataFrame:
    """Replace the ``body`` text by its array of ``games``.

    ``strict`` makes a malformed document fail the job.  Otherwise its text is
    kept in ``_corrupt`` and ``games`` is NULL.
    """
    schema = schemas.readable(schemas.ARCHIVE_DOCUMENT)
    others = [c for c in documents.columns if c != "body"]
    if strict:
        parsed = F.from_json("body", schema, {"mode": "FAILFAST"})
        return documents.select(*others, parsed["games"].alias("games"))
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("body", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return documents.select(*others, parsed.alias("doc")).select(
        *others, F.col("doc.games").alias("games"), F.col(f"doc.{CORRUPT}").alias(CORRUPT)
    )


def explode_games(documents: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per game with its position in the document (A1).

    ``keep_empty`` leaves one row with NULL ``pos`` for a document without games,
    which is how the action ledger sees it.
    """
    # Outer in both cases: before a plain explode Spark also tests the array for
    # emptiness, which would parse every document a second time.
    others = [c for c in documents.columns if c != "games"]
    exploded = documents.select(*others, F.posexplode_outer("games").alias("pos", "game"))
    return exploded if keep_empty else exploded.where(F.col("pos").isNotNull())


def explode_marked(documents: DataFrame) -> DataFrame:
    """One row per document with NULL ``pos``, which says whether it ``has_games``, and one per game.

    So a game can be dropped, and what its document is stays known.
    """
    kind = documents.schema["games"].dataType
    marker = F.array(F.lit(None).cast(kind.elementType))
    others = [c for c in documents.columns if c != "games"]
    marked = documents.select(
        *others,
        F.coalesce(F.size("games") > 0, F.lit(False)).alias("has_games"),
        F.posexplode(F.concat(marker, F.coalesce("games", F.array().cast(kind)))).alias("place", "game"),
    )
    return marked.select(*others, "has_games", F.when(F.col("place") > 0, F.col("place") - 1).alias("pos"), "game")


def games_rows(
    exploded: DataFrame, run_time: Column | dt.datetime, strict: bool = True, keep_empty: bool = False
) -> DataFrame:
    """The 14 columns of the ``games`` table, in order.

    Columns other than ``pos`` and ``game`` stay in front.  ``keep_empty`` leaves the rows of documents without games.
    """
    if not isinstance(run_time, Column):
        run_time = F.lit(run_time)
    game = F.col("game")
    columns = {
        "game_id": games.game_id(game["url"], strict),
        "game_date": games.epoch_date(game["end_time"]),
        "ingested_dt": run_time.cast("timestamp"),
        "eco": games.eco_or_pgn(game["eco"], game["pgn"]),
    }
    columns["opening"] = games.opening_name(columns["eco"])
    keep = [c for c in exploded.columns if c != "game"]
    names = schemas.GAMES.fieldNames()
    rows = exploded if keep_empty else exploded.where(F.col("pos").isNotNull())
    return rows.select(
        *keep, *[columns.get(name, game[name]).alias(name) for name in names]
    )


def action_ledger(exploded: DataFrame, run_time: Column | dt.datetime) -> DataFrame:
    """What was done with each endpoint: loaded, or to be deleted when empty."""
    has_games = F.col("pos").isNotNull()
    return _actions(exploded, has_games | F.col("has_games") if "has_games" in exploded.columns else has_games, run_time)


def document_actions(documents: DataFrame, run_time: Column | dt.datetime, strict: bool = True) -> DataFrame:
    """:func:`action_ledger` of documents that are not parsed yet: no field of a game is kept.

    A malformed document fails the job when ``strict``, else it has no action.
    """
    field = StructType([StructField("url", StringType())])
    schema = StructType([StructField("games", ArrayType(field)), StructField(CORRUPT, StringType())])
    if strict:
        parsed = F.from_json("body", StructType(schema.fields[:1]), {"mode": "FAILFAST"})
        rows = documents.select("endpoint", parsed.alias("doc"))
    else:
        parsed = F.from_json("body", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        rows = documents.select("endpoint", F.explode(F.array(parsed)).alias("doc")).where(f"doc.{CORRUPT} IS NULL")
    return _actions(rows, F.coalesce(F.size("doc.games") > 0, F.lit(False)), run_time)


def _actions(rows: DataFrame, has_games: Column, run_time: Column | dt.datetime) -> DataFrame:
    if not isinstance(run_time, Column):
        run_time = F.lit(run_time)
    return (
        rows.groupBy(F.col("endpoint").alias("gcs_endpoint"))
        .agg(F.max(has_games).alias("has_games"))
        .select(
            "gcs_endpoint",
            paths.endpoint_month(F.col("gcs_endpoint")).alias("gcs_game_month"),
            run_time.cast("timestamp").alias("gcs_object_interaction_dt"),
            F.when(F.col("has_games"), LOADED).otherwise(DELETED).alias("action_taken"),
        )
    )


def purge_list(ledger: DataFrame) -> DataFrame:
    """Empty objects that may be removed (A10)."""
    return ledger.where(F.col("action_taken") == DELETED)


def leaderboard_players(boards: DataFrame, body: str = "body") -> DataFrame:
    """Distinct lower-case players over all formats of all boards (A3).

    Values that are not lists of users, such as a fetch time, hold no players.
    """
    return _board_players(boards, body).distinct()


def snapshot_players(boards: DataFrame, body: str = "body") -> DataFrame:
    """Players of each dated snapshot, and whether the snapshot before had them (A3, A4).

    The first snapshot's players are all new.  Snapshots are few, so each is known to the others by its date alone.
    """
    players = _board_players(boards, body, "snapshot_date").distinct()
    dates = players.select("snapshot_date").distinct()
    before = dates.select(
        "snapshot_date", F.lag("snapshot_date").over(Window.orderBy("snapshot_date")).alias("earlier")
    ).where("earlier IS NOT NULL")
    # What a snapshot holds is not new in the one that follows.
    known = players.join(before.select("earlier", F.col("snapshot_date").alias("later")), F.col("snapshot_date") == F.col("earlier"))
    known = known.select(F.col("later").alias("snapshot_date"), "player", F.lit(False).alias("fresh"))
    found = players.join(known, ["snapshot_date", "player"], "left")
    return found.select("snapshot_date", "player", F.coalesce("fresh", F.lit(True)).alias("is_new"))


def _board_players(boards: DataFrame, body: str, *keep: str) -> DataFrame:
    # Outer, as in explode_games, so that no text is parsed twice.
    formats = boards.select(*keep, F.explode_outer(F.from_json(body, "map<string,string>")).alias("format", "users"))
    users = formats.select(*keep, F.explode_outer(F.from_json("users", schemas.LEADERBOARD_USERS)).alias("user"))
    return users.select(*keep, F.lower("user.username").alias("player")).where("player IS NOT NULL")
