"""Display labels.  ``format_number`` rounds the exact binary value half-even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUNCATION_MARKER = "...(truncated)...\n"
UNDEFINED = "Undefined"


def win_pct(wins: Column, games: Column) -> Column:
    """Wins per hundred games, NULL without games."""
    return F.try_divide(wins, games) * 100


def _number(value: Column, pattern: str) -> Column:
    return F.call_function("format_number", value, F.lit(pattern))


def pct_label(pct: Column) -> Column:
    """``12.3%``."""
    return F.concat(_number(pct, "0.0"), F.lit("%"))


def kpi_label(key: Column, value: Column, whole: Column) -> Column:
    """Text of a KPI value; the unit follows from the metric's name.

    The first matching name decides.  ``whole`` marks counts, which carry no
    decimals.
    """
    name = F.lower(key)
    return (
        F.when(name.contains("current_month"), F.concat(_number(value, "0.00"), F.lit("%")))
        .when(name.contains("consumed"), F.concat(_number(value, "0.0"), F.lit("GB")))
        .when(name.contains("data"), F.concat(_number(value, "#,##0.000"), F.lit(" GB")))
        .when(name.contains("usd"), F.concat(F.lit("$"), _number(value, "#,##0.00")))
        .when(whole, _number(value, "#,##0"))
        .otherwise(_number(value, "#,##0.00"))
    )


def prettify(name: Column) -> Column:
    """``total_games`` as ``Total Games``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def capitalise(text: Column) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, 2, F.length(text))))


def scope_label(selection: Column) -> Column:
    """Scope of a chart out of the selected values."""
    everything = selection.isNull() | (F.size(selection) == 0) | F.array_contains(selection, "all")
    return F.when(everything, F.lit("All")).otherwise(F.array_join(F.transform(selection, capitalise), ", "))


def chart_title(selection: Column, suffix: str) -> Column:
    """``<scope> | <suffix>``."""
    return F.concat(scope_label(selection), F.lit(f" | {suffix}"))


def or_undefined(group: Column) -> Column:
    """NULL group shown as ``Undefined``."""
    return F.coalesce(group, F.lit(UNDEFINED))


def keep_tail(text: Column, max_chars: int = 1500) -> Column:
    """Last ``max_chars`` characters behind a marker; shorter text unchanged."""
    return F.when(
        F.length(text) > max_chars,
        F.concat(F.lit(TRUNCATION_MARKER), F.right(text, F.lit(max_chars))),
    ).otherwise(text)
