"""Gathering the small files that many loads leave in a table's partitions."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.session import scratch_path, scratch_root
from rookery.sources import tables

#: Bytes that a file of a gathered partition holds.
TARGET_BYTES = 128 << 20


def partition_files(spark: SparkSession, name: str, partition: str) -> DataFrame:
    """Files and bytes of each partition, and a sum that tells its files apart from others; no column is read."""
    files = tables.current(spark, name).select(partition, "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy(partition).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum(F.xxhash64("file_path").cast("decimal(38,0)")).alias("names"),
    )


def _journal(spark: SparkSession, name: str) -> str:
    """Where the rewrites of a table are noted: their staged rows, and whether they are done."""
    return f"{scratch_root(spark)}/compaction-of-{name}"


def _unfinished(spark: SparkSession, name: str) -> list[str]:
    try:
        notes = [json.loads(r.value) for r in spark.read.text(_journal(spark, name)).collect()]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted({n["staged"] for n in notes} - {n["staged"] for n in notes if n["done"]})


def _note(spark: SparkSession, name: str, staged: str, done: bool) -> None:
    line = json.dumps({"staged": staged, "done": done})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(_journal(spark, name))


def _without(rows: DataFrame, partitions: DataFrame, partition: str) -> DataFrame:
    other = partitions.select(F.col(partition).alias("_other")).distinct()
    return rows.join(other, F.col(partition).eqNullSafe(F.col("_other")), "left_anti")


def settle(spark: SparkSession, name: str, partition: str) -> None:
    """Finish rewrites that stopped half-way.

    A partition is replaced by moving whole folders, so it is as it was, as it shall be, or gone;
    what is gone comes back from the staged rows.
    """
    for staged in _unfinished(spark, name):
        rows = spark.read.schema(spark.table(name).schema).parquet(staged)
        there = tables.stage(tables.current(spark, name).select(partition).distinct(), "there")
        tables.replace_partitions(_without(rows, there, partition), name)
        _note(spark, name, staged, done=True)


def compact(spark: SparkSession, name: str, partition: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite the partitions that have more files than their bytes need; returns files, bytes and needed files before.

    Rows of a partition are dealt evenly to as many files as it needs, staged, counted against the
    table, and only then put in place of the old files.  A partition that something has been added to meanwhile is left
    for the next time.  A run that stopped is finished by the next, and a second run finds nothing to do.  Loads must not
    run while partitions are replaced, nor before a stopped run is finished: Parquet tables have no transactions.
    """
    settle(spark, name, partition)
    needed = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))
    crowded = partition_files(spark, name, partition).withColumn("needed", needed).where("files > needed")
    crowded = tables.stage(crowded, "crowded")
    if not crowded.isEmpty():
        rows = tables.current(spark, name)
        chosen = crowded.select(F.col(partition).alias("_chosen"), "needed")
        dealt = rows.join(chosen, F.col(partition).eqNullSafe(F.col("_chosen")))
        # Every file is a key of its own, so a large partition is written by as many tasks as it has files.
        dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("needed")))
        location = scratch_path(spark, "compacted")
        dealt.repartition(partition, "_file").select(*rows.columns).write.parquet(location)
        staged = spark.read.schema(rows.schema).parquet(location)
        sides = [f.groupBy(partition).agg(F.count(F.lit(1)).alias("n")) for f in (staged, rows)]
        differ = sides[0].exceptAll(sides[1])
        now = partition_files(spark, name, partition).select(partition, "names")
        added = crowded.select(partition, "names").exceptAll(now)
        # Listed first: what is written must not read the table.
        left_out = tables.stage(differ.select(partition).union(added.select(partition)), "left-out")
        _note(spark, name, location, done=False)
        tables.replace_partitions(_without(staged, left_out, partition), name)
        _note(spark, name, location, done=True)
    return crowded.drop("names")
