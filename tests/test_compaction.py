"""Gathering small files: nothing lost, also when a run stops."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from rookery import scratch_path
from rookery.plans import compaction
from rookery.sources import tables


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    tables.ensure_database(spark, name, scratch_path(spark, name))
    rows = spark.range(600).selectExpr(
        "id", "concat('text ', id) AS s", "CASE WHEN id % 7 < 5 THEN date_add(DATE '2025-01-01', cast(id % 7 AS int)) END AS d"
    )
    schema = rows.schema
    tables.ensure_table(spark, f"{name}.rows", schema, "d")
    for part in range(8):
        tables.append(rows.where(F.col("id") % 8 == part), f"{name}.rows", "d")
    yield f"{name}.rows"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(spark, name):
    return sorted((r.id, r.s, str(r.d)) for r in tables.current(spark, name).select("id", "s", "d").collect())


def files_of(spark, name):
    return {str(r.d): r.files for r in compaction.partition_files(spark, name, "d").collect()}


def test_rows_stay_and_files_go(spark, table):
    before = rows_of(spark, table)
    assert min(files_of(spark, table).values()) == 8 and len(before) == 600
    first = compaction.compact(spark, table, "d").collect()
    assert {str(r.d) for r in first} == set(files_of(spark, table)) and {r.files for r in first} == {8}
    assert rows_of(spark, table) == before and set(files_of(spark, table).values()) == {1}
    # A second run finds nothing; a load after it is gathered alone.
    assert compaction.compact(spark, table, "d").collect() == []
    tables.append(tables.stage(spark.table(table).where("id < 5"), "more"), table, "d")
    (crowded,) = {len(compaction.compact(spark, table, "d").collect())}
    assert 0 < crowded <= 5 and set(files_of(spark, table).values()) == {1} and len(rows_of(spark, table)) == 605


def test_a_large_partition_keeps_as_many_files_as_it_needs(spark, table):
    size = max(r.bytes for r in compaction.partition_files(spark, table, "d").collect())
    compaction.compact(spark, table, "d", target_bytes=size // 3)
    assert max(files_of(spark, table).values()) <= 5 and len(rows_of(spark, table)) == 600


def test_other_partitions_stay(spark, table):
    new = spark.createDataFrame([(1, "new", dt.date(2025, 1, 2))], "id long, s string, d date")
    tables.replace_partitions(new, table)
    days = {str(r.d): r["count"] for r in tables.current(spark, table).groupBy("d").count().collect()}
    assert days.pop("2025-01-02") == 1 and len(days) == 5 and min(days.values()) >= 85


@pytest.mark.parametrize("lost", [0, 2])
def test_a_run_that_stops_is_finished_by_the_next(spark, table, monkeypatch, lost):
    before = rows_of(spark, table)

    def stop(rows, name):
        # Some partitions are gone, none has come.
        for day in [r.d for r in rows.select("d").where("d IS NOT NULL").distinct().orderBy("d").limit(lost).collect()]:
            spark.sql(f"ALTER TABLE {name} DROP PARTITION (d = DATE '{day}')")
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(tables, "replace_partitions", stop)
        compaction.compact(spark, table, "d")
    assert (rows_of(spark, table) == before) == (lost == 0)
    compaction.compact(spark, table, "d")
    assert rows_of(spark, table) == before and set(files_of(spark, table).values()) == {1}


def test_a_partition_that_grew_meanwhile_is_left(spark, table, monkeypatch):
    files = compaction.partition_files
    calls = []

    def grow(session, name, partition):
        calls.append(name)
        if len(calls) == 2:
            tables.append(tables.stage(spark.table(name).where("id = 0"), "late"), name, "d")
        return files(session, name, partition)

    monkeypatch.setattr(compaction, "partition_files", grow)
    compaction.compact(spark, table, "d")
    monkeypatch.undo()
    found = files_of(spark, table)
    assert found["2025-01-01"] == 9 and sorted(found.values())[:5] == [1] * 5
    assert len(rows_of(spark, table)) == 601
