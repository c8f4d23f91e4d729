"""URLs and object paths of the archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where the player and the period stand in a request URL.
PLAYER_PERIOD_PATTERN = r"player/([^/]+)/games/(\d{4}/\d{2})"


def last_component(url: Column) -> Column:
    """Text after the last ``/``; empty after a trailing slash (B1)."""
    return F.substring_index(url, "/", -1)


def endpoint(player: Column, period: Column) -> Column:
    """Object path of one player and one ``YYYY/MM`` period."""
    return F.concat(F.lit("player/"), player, F.lit("/games/"), period)


def player_of(url: Column) -> Column:
    """Player named in a URL, NULL when the URL is not a request URL."""
    return F.nullif(F.regexp_extract(url, PLAYER_PERIOD_PATTERN, 1), F.lit(""))


def period_of(url: Column) -> Column:
    """Period named in a URL, NULL when the URL is not a request URL."""
    return F.nullif(F.regexp_extract(url, PLAYER_PERIOD_PATTERN, 2), F.lit(""))


def request_parts(url: Column) -> Column:
    """Array of the part of a URL that names player and period; empty when the URL is not a request URL.

    To be exploded: a generated column is computed once, however often the columns and filters above it use it.
    """
    return F.slice(F.regexp_extract_all(url, F.lit(PLAYER_PERIOD_PATTERN), F.lit(0)), 1, 1)


def endpoint_month(path: Column) -> Column:
    """First day of the month an endpoint path stands for."""
    year = F.split_part(path, F.lit("/"), F.lit(4)).cast("int")
    month = F.split_part(path, F.lit("/"), F.lit(5)).cast("int")
    return F.make_date(year, month, F.lit(1))


def request_url(path: Column, base_url: str) -> Column:
    """Request URL of an endpoint path."""
    return F.concat(F.lit(base_url), path)


def under_any(path: Column, folders: Sequence[str]) -> Column:
    """Whether a path lies below one of the folders."""
    hit = F.lit(False)
    for folder in folders:
        hit = hit | path.startswith(f"{folder}/")
    return hit


def add_prefix(path: Column, prefix: str, excluded: Sequence[str] = ()) -> Column:
    """Path moved below ``prefix`` unless it lies in an excluded folder."""
    return F.when(under_any(path, excluded), path).otherwise(F.concat(F.lit(f"{prefix}/"), path))


def rename_prefix(path: Column, old: str, new: str) -> Column:
    """Leading ``old`` replaced by ``new``, once; other paths unchanged."""
    tail = F.substring(path, len(old) + 1, F.length(path))
    return F.when(path.startswith(old), F.concat(F.lit(new), tail)).otherwise(path)
