"""Required columns must not be NULL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A required column holds NULLs."""


def violations(rows: DataFrame, paths: Iterable[str]) -> DataFrame:
    """NULLs per required path, also inside records: path, violations.

    All paths are counted in one pass.
    """
    paths = list(paths)
    counts = rows.agg(*[F.count_if(F.col(p).isNull()).alias(f"c{i}") for i, p in enumerate(paths)])
    pairs = [F.struct(F.lit(p).alias("path"), F.col(f"c{i}").alias("violations")) for i, p in enumerate(paths)]
    return counts.select(F.inline(F.array(*pairs)))


def null_counts(paths: Iterable[str], among: Column) -> dict[str, Column]:
    """NULLs per required path among some rows, as aggregates that can be observed while the rows are written."""
    return {path: F.count_if(among & F.col(path).isNull()) for path in paths}


def refuse(found: Mapping[str, int]) -> None:
    """Raise :class:`ContractError` when any path has NULLs."""
    broken = [f"{path}: {n}" for path, n in found.items() if n]
    if broken:
        raise ContractError(", ".join(broken))


def breaks_contract(paths: Iterable[str]) -> Column:
    """Whether any required path of a row is NULL."""
    broken = F.lit(False)
    for path in paths:
        broken = broken | F.col(path).isNull()
    return broken


def split_rejects(rows: DataFrame, paths: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and rows that break it."""
    broken = breaks_contract(list(paths))
    return rows.where(~broken), rows.where(broken)


def check(rows: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Rows unchanged; raise :class:`ContractError` when any breaks the contract."""
    refuse({r["path"]: r["violations"] for r in violations(rows, paths).collect()})
    return rows
