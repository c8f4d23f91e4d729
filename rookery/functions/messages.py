"""Columns of encoded event messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def payload_text(data: Column) -> Column:
    """Decoded text of a base64 message; NULL when absent or not base64."""
    return F.try_to_binary(data, F.lit("base64")).cast("string")


def payload(data: Column, schema: StructType) -> Column:
    """Fields of a base64 JSON message."""
    return F.from_json(payload_text(data), schema)


def is_json(text: Column) -> Column:
    """Whether a text parses as JSON."""
    return F.try_parse_json(text).isNotNull()


def worker_name(script_name: Column) -> Column:
    """``my_job.py`` as ``my-job``."""
    return F.replace(F.split_part(script_name, F.lit("."), F.lit(1)), F.lit("_"), F.lit("-"))


def worker_image(job_name: Column, registry: str) -> Column:
    """Image a worker runs."""
    return F.concat(F.lit(f"{registry}/"), job_name, F.lit(":latest"))
