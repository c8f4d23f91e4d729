"""Event messages: decoding, filtering, validation.  Works on batches and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery import schemas
from rookery.functions import messages


def decode_jobs(rows: DataFrame, data: str = "data") -> DataFrame:
    """Fields of encoded job messages next to the message."""
    others = [c for c in rows.columns if c != data]
    return rows.select(*others, messages.payload(F.col(data), schemas.JOB_MESSAGE).alias("job")).select(
        *others, "job.*"
    )


def project_workers(jobs: DataFrame, registry: str) -> DataFrame:
    """Name and image of the worker each job message asks for."""
    return jobs.withColumns(
        {
            "worker": messages.worker_name(F.col("script_name")),
            "image": messages.worker_image(F.col("job_name"), registry),
        }
    )


def decode_logs(rows: DataFrame, data: str = "data") -> DataFrame:
    """Fields of encoded log entries, and whether the text was JSON at all."""
    others = [c for c in rows.columns if c != data]
    text = messages.payload_text(F.col(data))
    log = F.col("log")
    return (
        rows.select(
            *others,
            F.col(data).isNotNull().alias("has_data"),
            messages.is_json(text).alias("is_json"),
            F.from_json(text, schemas.LOG_MESSAGE).alias("log"),
        )
        .select(
            *others,
            "has_data",
            "is_json",
            log["logName"].alias("log_name"),
            log["resource"]["type"].alias("resource_type"),
            log["resource"]["labels"]["zone"].alias("zone"),
            log["jsonPayload"]["_HOSTNAME"].alias("hostname"),
            log["jsonPayload"]["MESSAGE"].alias("message"),
        )
    )


def filter_events(
    logs: DataFrame,
    log_name: str,
    resource_type: str,
    message_parts: Sequence[str],
) -> DataFrame:
    """Log entries of one log and type whose message holds all parts.

    The parts are matched without regard to case.
    """
    logs = logs.where((F.col("log_name") == log_name) & (F.col("resource_type") == resource_type))
    for part in message_parts:
        logs = logs.where(F.lower("message").contains(part.lower()))
    return logs


def reject_reason(logs: DataFrame) -> DataFrame:
    """Why a log message cannot be handled; NULL for a valid one."""
    reason = (
        F.when(~F.col("has_data"), "missing data")
        .when(~F.col("is_json"), "malformed message")
        .when(F.coalesce("hostname", F.lit("")) == "", "missing host")
        .when(F.coalesce("zone", F.lit("")) == "", "missing zone")
    )
    return logs.withColumn("reject_reason", reason)


def valid(logs: DataFrame) -> DataFrame:
    """Messages without a reject reason."""
    return logs.where("reject_reason IS NULL")


def rejected(logs: DataFrame) -> DataFrame:
    """Messages with a reject reason."""
    return logs.where("reject_reason IS NOT NULL")
