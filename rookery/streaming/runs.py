"""Running a stream over what is there, to a Parquet sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

from pyspark.sql.types import StructType


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for stateful streams, sized to the cluster.

    The number of state partitions is fixed for the life of a checkpoint and is
    not adapted at run time, so it follows the cores rather than the default.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.streaming.stateStore.providerClass"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return own


def file_stream(
    spark: SparkSession,
    location: str,
    schema: StructType,
    source_format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Files that land in a folder, each seen once."""
    reader: DataStreamReader = spark.readStream.schema(schema).format(source_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(location)


def run_to_files(rows: DataFrame, location: str, checkpoint: str) -> None:
    """Process all available input once and append the result as Parquet."""
    run = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", location)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
