"""Columns of the ``games`` table derived from raw archive games."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rookery.functions.paths import last_component

# The header tag that carries the opening link, and the marker for its absence.
ECO_TAG_PATTERN = r'\[ECOUrl\s+"([^"]+)"\]'
ECO_NOT_FOUND = "ECO Not Found"


def eco_from_pgn(pgn: Column) -> Column:
    """Opening link in the PGN header, or the not-found marker (B2)."""
    return F.coalesce(F.nullif(F.regexp_extract(pgn, ECO_TAG_PATTERN, 1), F.lit("")), F.lit(ECO_NOT_FOUND))


def eco_or_pgn(eco: Column, pgn: Column) -> Column:
    """Given link, else the one in the PGN, else the marker."""
    return F.coalesce(eco, eco_from_pgn(pgn))


def opening_name(eco: Column) -> Column:
    """Readable opening name out of its link."""
    return F.coalesce(F.replace(last_component(eco), F.lit("-"), F.lit(" ")), F.lit(ECO_NOT_FOUND))


def game_id(url: Column, strict: bool = True) -> Column:
    """Numeric id at the end of a game URL.

    ``strict`` makes a non-numeric id fail the job; otherwise it becomes NULL
    and the row can be rejected.
    """
    text = last_component(url)
    return text.cast("bigint") if strict else text.try_cast("bigint")


def epoch_timestamp(seconds: Column, zone: str = "UTC") -> Column:
    """Epoch seconds as a timestamp showing the wall clock of ``zone``."""
    instant = F.timestamp_seconds(seconds)
    return instant if zone == "UTC" else F.from_utc_timestamp(instant, zone)


def epoch_date(seconds: Column) -> Column:
    """Epoch seconds as a UTC calendar date (B6); the session zone is UTC."""
    return F.to_date(F.timestamp_seconds(seconds))
