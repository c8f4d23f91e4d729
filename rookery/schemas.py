"""Table and document schemas.

``nullable=False`` marks a required column.  Spark does not enforce it when it
reads files, so :mod:`rookery.operators.quality` checks it explicitly.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _required(name: str, data_type: DataType) -> StructField:
    return StructField(name, data_type, nullable=False)


def _optional(name: str, data_type: DataType) -> StructField:
    return StructField(name, data_type, nullable=True)


SIDE = StructType(
    [
        _required("uuid", StringType()),
        _required("username", StringType()),
        _required("rating", LongType()),
        _required("result", StringType()),
    ]
)

ACCURACIES = StructType([_optional("white", DoubleType()), _optional("black", DoubleType())])

GAMES = StructType(
    [
        _required("game_id", LongType()),
        _required("url", StringType()),
        _required("game_date", DateType()),
        _required("ingested_dt", TimestampType()),
        _required("time_control", StringType()),
        _required("end_time", LongType()),
        _required("rated", BooleanType()),
        _required("time_class", StringType()),
        _required("rules", StringType()),
        _required("white", SIDE),
        _required("black", SIDE),
        _optional("accuracies", ACCURACIES),
        _required("eco", StringType()),
        _required("opening", StringType()),
    ]
)

LOAD_LEDGER = StructType(
    [
        _required("gcs_endpoint", StringType()),
        _required("gcs_game_month", DateType()),
        _required("gcs_object_interaction_dt", TimestampType()),
        _optional("action_taken", StringType()),
    ]
)

# What a lenient load could not take: a document (no position) or one of its games; the part, where documents have one;
# a hash of the text, which tells texts of one place apart, and the endpoint's month.
LOAD_REJECTS = StructType(
    [
        _required("endpoint", StringType()),
        _optional("part", StringType()),
        _optional("pos", IntegerType()),
        _required("reason", StringType()),
        _optional("text", StringType()),
        _optional("text_hash", StringType()),
        _optional("game_month", DateType()),
        _required("rejected_dt", TimestampType()),
        _required("rejected_date", DateType()),
    ]
)

# One game inside an archive document.
RAW_GAME = StructType(
    [
        _optional("url", StringType()),
        _optional("end_time", LongType()),
        _optional("time_control", StringType()),
        _optional("rated", BooleanType()),
        _optional("time_class", StringType()),
        _optional("rules", StringType()),
        _optional("white", SIDE),
        _optional("black", SIDE),
        _optional("accuracies", ACCURACIES),
        _optional("eco", StringType()),
        _optional("pgn", StringType()),
    ]
)

ARCHIVE_DOCUMENT = StructType([_optional("games", ArrayType(RAW_GAME))])

# One landed response: the endpoint it belongs to and the body as received.
LANDING = StructType(
    [
        _required("endpoint", StringType()),
        _required("player", StringType()),
        _required("period", StringType()),
        _required("url", StringType()),
        _required("body", StringType()),
    ]
)

REQUEST_LEDGER = StructType(
    [
        _required("player", StringType()),
        _required("period", StringType()),
        _required("outcome", StringType()),
    ]
)

REQUESTS = StructType(
    [
        _required("player", StringType()),
        _required("endpoint", StringType()),
        _required("url", StringType()),
        _required("period", StringType()),
    ]
)

LEADERBOARD_USERS = ArrayType(StructType([_optional("username", StringType())]))

WEEKLY_OPENINGS = StructType(
    [
        _required("week_start", DateType()),
        _optional("time_class", StringType()),
        _optional("opening_archetype", StringType()),
        _optional("total_games", LongType()),
        _optional("white_win_count", LongType()),
        _optional("black_win_count", LongType()),
    ]
)

JOB_LOG = StructType(
    [
        _optional("creation_time", TimestampType()),
        _optional("project_id", StringType()),
        _optional("user_email", StringType()),
        _optional("job_id", StringType()),
        _optional("start_time", TimestampType()),
        _optional("end_time", TimestampType()),
        _optional("job_type", StringType()),
        _optional("statement_type", StringType()),
        _optional("priority", StringType()),
        _optional("cache_hit", BooleanType()),
        _optional("total_slot_ms", LongType()),
        _optional("total_bytes_processed", LongType()),
        _optional("total_bytes_billed", LongType()),
    ]
)

USER_NUMBERS = StructType([_required("user_email", StringType()), _required("user_number", LongType())])

# Users of a day as bits, by bucket of 32,768 numbers.
USER_DAYS = StructType(
    [
        _required("job_created_date", DateType()),
        _required("bucket", LongType()),
        _required("bitmap", BinaryType()),
    ]
)

RUNS_TRIGGERED = StructType(
    [
        _required("run_id", StringType()),
        _required("run_start_date", DateType()),
        _required("run_start_dt", TimestampType()),
        _required("script_name", StringType()),
        _required("environment", StringType()),
        _required("hostname", StringType()),
        _required("python_version", StringType()),
    ]
)

RUNS_FAILED = StructType(
    [
        _required("run_id", StringType()),
        _required("run_failed_date", DateType()),
        _required("run_failed_dt", TimestampType()),
        _required("failed_filename", StringType()),
        _required("exception_type", StringType()),
        _required("exception_value", StringType()),
        _required("stack_trace", StringType()),
    ]
)

JOB_MESSAGE = StructType(
    [
        _optional("script_name", StringType()),
        _optional("job_name", StringType()),
        _optional("app_env", StringType()),
        _optional("project_id", StringType()),
        _optional("bucket_name", StringType()),
        _optional("start_date", StringType()),
        _optional("end_date", StringType()),
    ]
)

LOG_MESSAGE = StructType(
    [
        _optional("logName", StringType()),
        _optional(
            "resource",
            StructType(
                [
                    _optional("type", StringType()),
                    _optional("labels", StructType([_optional("zone", StringType())])),
                ]
            ),
        ),
        _optional(
            "jsonPayload",
            StructType([_optional("_HOSTNAME", StringType()), _optional("MESSAGE", StringType())]),
        ),
    ]
)


def required_paths(schema: StructType, prefix: str = "") -> Iterator[str]:
    """Dotted paths of all required columns, also those inside records."""
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        if not field.nullable:
            yield path
        if isinstance(field.dataType, StructType):
            yield from required_paths(field.dataType, f"{path}.")


def readable(schema: StructType) -> StructType:
    """The same schema with every column nullable, for reading files."""

    def relax(data_type: DataType) -> DataType:
        if isinstance(data_type, StructType):
            return StructType([StructField(f.name, relax(f.dataType), True) for f in data_type.fields])
        if isinstance(data_type, ArrayType):
            return ArrayType(relax(data_type.elementType), True)
        return data_type

    return relax(schema)
