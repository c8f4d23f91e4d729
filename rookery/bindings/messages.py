"""Event messages and run monitor rows on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.bindings.views import V_MSG, messages, plain, table, with_cte
from rookery.operators import messages as ops
from rookery.operators import monitor

LOG_NAME = "logs/system"
RESOURCE_TYPE = "vm_instance"
MESSAGE_PARTS = ("container die", "image=registry/worker-1")
REGISTRY = "registry/workers"


def _logs(spark, sf_dir):
    return ops.decode_logs(messages(spark, sf_dir).select("event_id", "log_data"), "log_data")


def decode_messages(spark, sf_dir):
    return ops.decode_jobs(messages(spark, sf_dir).select("event_id", "job_data"), "job_data").select(
        "event_id", "script_name", "job_name", "app_env", "start_date", "end_date"
    )


def message_projection(spark, sf_dir):
    jobs = ops.decode_jobs(messages(spark, sf_dir).select("event_id", "job_data"), "job_data")
    return ops.project_workers(jobs, REGISTRY).select("event_id", "worker", "image")


def event_log_filter(spark, sf_dir):
    return ops.filter_events(_logs(spark, sf_dir), LOG_NAME, RESOURCE_TYPE, MESSAGE_PARTS).select(
        "event_id", "hostname", "zone", "message"
    )


def message_validation(spark, sf_dir):
    return ops.reject_reason(_logs(spark, sf_dir)).select("event_id", "reject_reason")


def _runs(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.col("ts").cast("timestamp").alias("failed_at"),
        F.concat(kind, F.lit(".py")).alias("script_name"),
        F.when(kind != "view", "PROD").alias("environment"),
        F.concat(F.lit("host-"), "user_id").alias("hostname"),
        F.lit("3").alias("python_version"),
        kind.alias("kind"),
        F.lit("ValueError").alias("exception_type"),
        F.col("value").cast("string").alias("exception_value"),
        F.repeat("props", F.lit(200)).alias("stack_trace"),
    )


def run_monitor_rows(spark, sf_dir):
    rows = monitor.triggered_runs(_runs(spark, sf_dir))
    return rows.withColumn("run_start_dt", F.col("run_start_dt").cast("timestamp_ntz"))


def run_monitor_failures(spark, sf_dir):
    rows = monitor.failed_runs(_runs(spark, sf_dir).where("kind = 'error'"))
    # Doubles print differently in the two engines.
    value = F.round(F.col("exception_value").cast("double"), 6).alias("exception_value")
    names = ("failed_filename", "exception_type", "stack_trace")
    return rows.select("run_id", "run_failed_date", *plain("run_failed_dt"), *names, value)


QUERIES = {
    "decode_messages": decode_messages,
    "message_projection": message_projection,
    "event_log_filter": event_log_filter,
    "message_validation": message_validation,
    "run_monitor_rows": run_monitor_rows,
    "run_monitor_failures": run_monitor_failures,
}

# What a log message decodes to: nothing without data or from a text cut short.
VALID_EVENTS_SQL = """SELECT event_id, hostname, zone, message FROM v_msg
WHERE parses AND log_name = 'logs/system' AND lower(message) LIKE '%container die%'
  AND lower(message) LIKE '%image=registry/worker-1%'"""

ORACLE = {
    "decode_messages": with_cte(V_MSG)
    + """SELECT event_id, CASE WHEN has_data THEN script_name END AS script_name,
  CASE WHEN has_data THEN job_name END AS job_name, CASE WHEN has_data THEN 'PROD' END AS app_env,
  CASE WHEN has_data THEN start_date END AS start_date, CAST(NULL AS VARCHAR) AS end_date FROM v_msg""",
    "message_projection": with_cte(V_MSG)
    + """SELECT event_id, CASE WHEN has_data THEN replace(split_part(script_name, '.', 1), '_', '-') END AS worker,
  CASE WHEN has_data THEN 'registry/workers/' || job_name || ':latest' END AS image FROM v_msg""",
    "event_log_filter": with_cte(V_MSG) + VALID_EVENTS_SQL,
    "message_validation": with_cte(V_MSG)
    + """SELECT event_id, CASE WHEN NOT has_data THEN 'missing data' WHEN NOT parses THEN 'malformed message'
  WHEN hostname = '' THEN 'missing host' WHEN zone IS NULL THEN 'missing zone' END AS reject_reason FROM v_msg""",
    "run_monitor_rows": """SELECT CAST(event_id AS VARCHAR) AS run_id, CAST(ts AS DATE) AS run_start_date,
  date_trunc('second', ts) AS run_start_dt, event_type || '.py' AS script_name,
  CASE WHEN event_type <> 'view' THEN 'PROD' ELSE 'UNDEFINED' END AS environment, 'host-' || user_id AS hostname,
  '3' AS python_version FROM events""",
    "run_monitor_failures": """SELECT CAST(event_id AS VARCHAR) AS run_id, CAST(ts AS DATE) AS run_failed_date,
  date_trunc('second', ts) AS run_failed_dt, event_type || '.py' AS failed_filename, 'ValueError' AS exception_type,
  round(value, 6) AS exception_value,
  CASE WHEN length(repeat(props, 200)) > 1500 THEN '...(truncated)...' || chr(10) || right(repeat(props, 200), 1500)
    ELSE repeat(props, 200) END AS stack_trace FROM events WHERE event_type = 'error'""",
}
