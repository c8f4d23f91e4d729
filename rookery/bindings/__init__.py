"""Operators bound to the given tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rookery.bindings import archive, columns, keys, messages, openings, streams, usage
from rookery.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_FAMILIES = (openings, usage, columns, keys, archive, messages, streams)


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__doc__ = query.__doc__
    run.__name__ = query.__name__
    return run


def queries() -> dict[str, Query]:
    return {key: _configured(query) for family in _FAMILIES for key, query in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: sql for family in _FAMILIES for key, sql in family.ORACLE.items()}
