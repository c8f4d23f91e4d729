"""Event messages, run monitor and windowed streams."""

from __future__ import annotations

import base64
import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from rookery import schemas, scratch_path
from rookery.operators import messages as ops
from rookery.operators import monitor, quality
from rookery.plans import monitoring
from rookery.streaming import counts
from rookery.streaming import messages as message_stream
from rookery.streaming.runs import file_stream, run_to_files

PARTS = ("container die", "image=registry/worker")


def encode(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return base64.b64encode(text.encode()).decode()


def log(host="vm-1", zone="z", message="Container DIE 1 image=registry/worker-1", name="logs/system"):
    labels = {} if zone is None else {"zone": zone}
    return {
        "logName": name,
        "resource": {"type": "vm", "labels": labels},
        "jsonPayload": {"_HOSTNAME": host, "MESSAGE": message},
    }


MESSAGES = [
    ("valid", encode(log())),
    ("no data", None),
    ("empty host", encode(log(host=""))),
    ("no zone", encode(log(zone=None))),
    ("malformed", encode('{"logName": "logs/sys')),
    ("not base64", "%%%"),
    ("started", encode(log(message="container start image=registry/worker-1"))),
    ("other log", encode(log(name="logs/audit"))),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(MESSAGES, "id string, data string")


def test_reject_reasons(rows):
    got = {r.id: r.reject_reason for r in ops.reject_reason(ops.decode_logs(rows)).collect()}
    assert got == {
        "valid": None,
        "no data": "missing data",
        "empty host": "missing host",
        "no zone": "missing zone",
        "malformed": "malformed message",
        "not base64": "malformed message",
        "started": None,
        "other log": None,
    }
    checked = ops.reject_reason(ops.decode_logs(rows))
    assert (ops.valid(checked).count(), ops.rejected(checked).count()) == (3, 5)


def test_filter(rows):
    kept = ops.filter_events(ops.decode_logs(rows), "logs/system", "vm", PARTS)
    assert {r.id for r in kept.collect()} == {"valid", "empty host", "no zone"}


def test_workers(spark):
    data = [("a", encode({"script_name": "my_job.py", "job_name": "runner", "test_volume": 2})), ("b", None)]
    jobs = ops.project_workers(ops.decode_jobs(spark.createDataFrame(data, "id string, data string")), "reg/repo")
    got = {r.id: (r.worker, r.image) for r in jobs.collect()}
    assert got == {"a": ("my-job", "reg/repo/runner:latest"), "b": (None, None)}


def test_stream_equals_batch(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), rows.schema, max_files=1)
    handled = message_stream.handled_events(stream, "logs/system", "vm", PARTS)
    run_to_files(handled, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    batch = message_stream.handled_events(rows, "logs/system", "vm", PARTS)
    assert spark.read.parquet(str(tmp_path / "out")).collect() == batch.collect() != []


def test_monitor(spark):
    when = dt.datetime(2025, 1, 2, 3, 4, 5, 678901)
    runs = spark.createDataFrame(
        [("r", when, "s.py", None, "h", "3")],
        "run_id string, started_at timestamp, script_name string, environment string, hostname string, python_version string",
    )
    row = monitor.triggered_runs(runs).first()
    assert row.run_start_dt == when.replace(microsecond=0) and row.run_start_date == when.date()
    assert row.environment == "UNDEFINED"
    failures = spark.createDataFrame(
        [("r", when, "s.py", "ZeroDivisionError", "division by zero", "x" * 2000)],
        "run_id string, failed_at timestamp, script_name string, exception_type string, exception_value string, stack_trace string",
    )
    failed = monitor.failed_runs(failures)
    assert failed.columns == schemas.RUNS_FAILED.fieldNames()
    assert failed.first().stack_trace == "...(truncated)...\n" + "x" * 1500

    name = f"t_{uuid.uuid4().hex}"
    target = monitoring.MonitorTables.create(spark, name, scratch_path(spark, name))
    monitoring.record_triggered(runs, target)
    monitoring.record_failed(failures, target)
    assert spark.table(target.triggered).count() == spark.table(target.failed).count() == 1
    with pytest.raises(quality.ContractError, match="stack_trace: 1"):
        monitoring.record_failed(failures.withColumn("stack_trace", F.lit(None).cast("string")), target)
