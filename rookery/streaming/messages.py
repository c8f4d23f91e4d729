"""Message handling as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rookery.operators import messages


def handled_events(
    rows: DataFrame,
    log_name: str,
    resource_type: str,
    message_parts: Sequence[str],
    data: str = "data",
) -> DataFrame:
    """Decoded, filtered and valid log messages."""
    logs = messages.decode_logs(rows, data)
    return messages.valid(messages.reject_reason(messages.filter_events(logs, log_name, resource_type, message_parts)))
