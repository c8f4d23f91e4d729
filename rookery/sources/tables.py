"""Catalog tables: run SQL, create, append, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rookery.session import scratch_path

# How times are written to CSV, and to be read again.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def query(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text, lazily.

    ``args`` fill ``:name`` parameters, ``tables`` fill ``{name}`` placeholders.
    """
    return spark.sql(sql, args=args, **tables)


def _column_ddl(schema: StructType) -> str:
    parts = []
    for field in schema.fields:
        required = "" if field.nullable else " NOT NULL"
        parts.append(f"`{field.name}` {field.dataType.simpleString()}{required}")
    return ", ".join(parts)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database unless it exists."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def ensure_table(spark: SparkSession, name: str, schema: StructType, partition_column: str | None = None) -> None:
    """Create a Parquet table unless it exists, partitioned by a column if given."""
    if not spark.catalog.tableExists(name):
        partitioned = f" PARTITIONED BY (`{partition_column}`)" if partition_column else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_column_ddl(schema)}) USING parquet{partitioned}")


def current(spark: SparkSession, name: str) -> DataFrame:
    """A table with the files it has now.

    A session remembers the files it listed; those another session or stream has
    appended since are only seen after a refresh.
    """
    spark.catalog.refreshTable(name)
    return spark.table(name)


def stage(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared scratch folder and read back from there.

    Later steps start from the written files, whatever happens to the executors
    that made them.
    """
    spark = rows.sparkSession
    location = scratch_path(spark, label)
    rows.write.parquet(location)
    return spark.read.schema(rows.schema).parquet(location)


def stage_measured(rows: DataFrame, label: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Any]]:
    """:func:`stage`, and aggregates of the rows taken while they are written: no job of their own.

    What is written by a task that is repeated may count twice, so sums are to be compared with zero, or
    taken where every task ends in the write.
    """
    seen = Observation()
    names = {f"m{i}": name for i, name in enumerate(metrics)}
    observed = rows.observe(seen, *[metrics[name].alias(alias) for alias, name in names.items()])
    staged = stage(observed, label)
    return staged, {name: seen.get[alias] for alias, name in names.items()}


def with_dates(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as dates."""
    return rows.withColumns({c: F.to_date(c) for c in columns})


def append(rows: DataFrame, table: str, partition_column: str | None = None) -> None:
    """Append rows, matching columns by name.

    Rows of one partition value are gathered to avoid small files; a value that
    holds much of the data is split over many tasks.
    """
    writer = rows.hint("rebalance", partition_column) if partition_column else rows
    writer = writer.write.mode("append").format("parquet")
    if partition_column:
        writer = writer.partitionBy(partition_column)
    writer.saveAsTable(table)


def replace_partitions(rows: DataFrame, table: str) -> None:
    """Put rows in place of the partitions that occur in them; all other partitions stay.

    The mode is a setting of the session: an option of the writer is not heard when a catalog table is written to,
    and the whole table would be replaced.
    """
    spark = rows.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)
    spark.catalog.refreshTable(table)


def export_csv(rows: DataFrame, location: str) -> None:
    """Write rows as CSV files with a header (A9); times keep their microseconds."""
    rows.write.mode("overwrite").option("header", True).options(**CSV_TIMES).csv(location)
