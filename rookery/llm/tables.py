"""What the operators of this subpackage share: reading, staging, words, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rookery.session import scratch_path

# Fixed value: a word is a run of anything but the six ASCII white space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes of rows that go to a Python worker at once: buffers on both sides stay small beside an executor's heap.
BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as each write ends: its table is then the only thing read again."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def staged(frame: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame below the shared scratch folder and read it back.

    Lineage ends at the written table, so a lost executor repeats a columnar
    read, not the work above it.
    """
    spark = frame.sparkSession
    spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    path = scratch_path(spark, label)
    with _shuffles_released(spark):
        frame.write.options(**(options or {})).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name that is read as one name, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def row_of(docs: DataFrame, keep: Iterable[str]) -> Column:
    """``row``: the columns of ``keep`` as they are, whatever their names."""
    return F.struct(*[F.col(quoted(name)).alias(name) for name in keep]).alias("row")


def with_row(rows: DataFrame, more: str) -> StructType:
    """Schema of ``row`` and of further columns given as text."""
    return StructType([rows.schema["row"], *StructType.fromDDL(more).fields])


def word_count(text: Column) -> Column:
    """Words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id's text leaves ``part`` when divided by ``parts``; a null id counts as an empty text."""
    return F.coalesce(F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % parts == part, F.lit(False))


def utf8(values: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of every text of an Arrow column, one at a time; null gives empty bytes."""
    chunks = values.chunks if isinstance(values, pa.ChunkedArray) else [values]
    for chunk in chunks:
        for value in chunk.cast(pa.large_binary() if pa.types.is_large_string(chunk.type) else pa.binary()):
            yield value.as_py() or b""


def map_batches(
    frame: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` over single batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return frame.mapInArrow(run, schema)
