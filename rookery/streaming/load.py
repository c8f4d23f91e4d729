"""The monthly load as a stream over landed responses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rookery.operators import archive
from rookery.plans.load import GameTables, LoadResult, game_rows, load_documents, store_rows


def start_load(
    documents: DataFrame,
    target: GameTables,
    checkpoint: str,
    run_time: dt.datetime | None = None,
    strict: bool = True,
) -> StreamingQuery:
    """Load newly landed documents batch by batch.

    The checkpoint remembers the files already seen.  The documents of one endpoint
    may lie in several files and come in several batches, so the ledger drops none
    of them: games are compared by id, which also lets a batch that is replayed
    after a failure add nothing twice.
    """

    def load_batch(batch: DataFrame, _: int) -> None:
        load_documents(batch, target, run_time or dt.datetime.now(dt.UTC), strict=strict, by_endpoint=False)

    return (
        documents.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def games_stream(documents: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Documents of a stream as games rows."""
    return archive.games_rows(archive.explode_games(archive.parse_documents(documents)), run_time)


def unique_rows(documents: DataFrame, run_time: dt.datetime, remember: str) -> DataFrame:
    """Rows of a stream of documents without the copies of what came within the last ``remember``.

    State holds the ids that came lately, by the time they came and not the time a game ended: that time
    only grows, so no row is behind the watermark and none is lost.  Documents and bad rows
    are told apart by place and text.  Which of two copies in one micro-batch goes on is not defined.
    """
    marked = archive.explode_marked(archive.parse_documents(documents, strict=False))
    rows = game_rows(marked, run_time, strict=False)
    others = [c for c in ("endpoint", "part", "pos", "reason", "text", "has_games") if c in rows.columns]
    good = F.col("pos").isNotNull() & F.col("reason").isNull()
    place = F.when(~good, F.sha2(F.to_json(F.struct(*others)), 256))
    keyed = rows.withColumns({"game_id": F.when(good, F.col("game_id")), "place": place, "arrived": F.current_timestamp()})
    once = keyed.withWatermark("arrived", remember).dropDuplicatesWithinWatermark(["game_id", "place"])
    return once.drop("place", "arrived")


def start_unique_games(
    documents: DataFrame,
    target: GameTables,
    checkpoint: str,
    run_time: dt.datetime | None = None,
    remember: str = "1 day",
    on_batch: Callable[[LoadResult], None] | None = None,
) -> StreamingQuery:
    """One row of each game of a stream, whenever its copies arrive (S3).

    Copies that come soon after each other end in the state store; what passes is compared with the
    table, of which only the days of the games that pass are read.  So however late or out of order
    a game comes, it is added if the table lacks its id.  Malformed documents and games are kept as
    rejects and stop nothing.  ``on_batch`` gets the result of each micro-batch.
    """
    run_time = run_time or dt.datetime.now(dt.UTC)

    def load_batch(batch: DataFrame, _: int) -> None:
        result = store_rows(batch, target, run_time, write=True, strict=False)
        if on_batch:
            on_batch(result)

    return (
        unique_rows(documents, run_time, remember)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
