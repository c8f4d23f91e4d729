"""Usage statistics on the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.bindings.views import USAGE_AS_OF, V_FACTS, job_log, plain, with_cte
from rookery.functions import labels
from rookery.operators import usage as ops
from rookery.plans.reports import usage_report
from rookery.plans.usage_state import UsageState, rolling_users, store_days
from rookery.session import scratch_path
from rookery.sources import tables

START, END = "2024-01-08", "2024-01-21"
USERS = ["user1@example.com", "user2@example.com", "user3@example.com", "user5@example.com", "user8@example.com"]
NEXT_MONTH = dt.date(2024, 2, 10)
REPORT_RANGE = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))


def _facts(spark, sf_dir):
    return ops.job_facts(ops.rolling_window(job_log(spark, sf_dir), USAGE_AS_OF))


def _user_days(spark, sf_dir):
    return ops.user_day(_facts(spark, sf_dir))


def _rounded(rows: DataFrame) -> DataFrame:
    doubles = [name for name, kind in rows.dtypes if kind == "double"]
    return rows.withColumns({c: F.round(c, 7) for c in doubles})


def job_time_parts(spark, sf_dir):
    """Days as text, as another system may hand them over, cast back on the way."""
    facts = _facts(spark, sf_dir).withColumn("job_created_date", F.col("job_created_date").cast("string"))
    facts = tables.with_dates(facts, ["job_created_date"])
    return facts.select("job_id", *plain("job_creation_dt"), "job_created_date", "job_created_month")


def job_unit_conversion(spark, sf_dir):
    return _rounded(
        _facts(spark, sf_dir).select(
            "job_id",
            "total_query_ms",
            "total_query_seconds",
            "total_slot_seconds",
            "total_megabytes_processed",
            "total_gigabytes_processed",
            "total_megabytes_billed",
            "total_gigabytes_billed",
        )
    )


def job_cost(spark, sf_dir):
    return _rounded(_facts(spark, sf_dir).select("job_id", "total_bytes_billed", "query_cost_usd"))


def job_rolling_window(spark, sf_dir):
    kept = ops.rolling_window(job_log(spark, sf_dir), "2025-01-15")
    return kept.select("job_id", "user_email", *plain("end_time"))


def user_day_usage(spark, sf_dir):
    return _rounded(_user_days(spark, sf_dir)).orderBy("job_created_date", "project_id", "user_email")


def usage_filter(spark, sf_dir):
    return _rounded(ops.usage_filter(_user_days(spark, sf_dir), START, END, USERS))


def jobs_over_gb(spark, sf_dir):
    jobs = ops.jobs_over(_facts(spark, sf_dir), 25.0)
    return _rounded(jobs.select("job_id", "user_email", "total_gigabytes_billed"))


def daily_metric_series(spark, sf_dir):
    return _rounded(ops.daily_series(_user_days(spark, sf_dir), "total_query_cost_usd"))


def usage_kpis(spark, sf_dir):
    return _rounded(ops.usage_kpis(_user_days(spark, sf_dir), START, END, USAGE_AS_OF, USERS))


def rolling_distinct_users(spark, sf_dir):
    """Users of each seven days, from bitmaps stored in two loads that share some days; the job log is not read again."""
    database = f"rookery_usage_{uuid.uuid4().hex}"
    state = UsageState.create(spark, database, scratch_path(spark, "usage"))
    facts = _facts(spark, sf_dir)
    day = F.dayofmonth("job_created_date")
    for part in (day <= 18, day >= 12):
        store_days(facts.where(part), state)
    found = tables.stage(rolling_users(spark, state, 7), "result")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


def usage_report_csv(spark, sf_dir):
    """Jobs of the usage report exported as CSV with a header, and read back."""
    location = scratch_path(spark, "csv")
    with usage_report(job_log(spark, sf_dir), USAGE_AS_OF, *REPORT_RANGE, USERS, minimum_gb=20.0) as report:
        shown = report["jobs"].withColumn("job_creation_dt", F.col("job_creation_dt").cast("timestamp_ntz"))
        tables.export_csv(shown, location)
        schema = shown.schema
    back = spark.read.option("header", True).options(**tables.CSV_TIMES).schema(schema).csv(location)
    return _rounded(back)


def usage_report_frames(spark, sf_dir):
    """Frames of the usage report, one below the other: frame, a name and a figure."""
    with usage_report(job_log(spark, sf_dir), USAGE_AS_OF, *REPORT_RANGE, USERS) as report:
        kpis, change = report["kpis"], report["month_over_month"]
        frames = [
            report["series"].select(F.lit("series").alias("frame"), F.col("job_created_date").cast("string").alias("a"),
                                    F.col("total_gigabytes_billed").alias("v")),
            report["users"].select(F.lit("users"), "user_email", F.lit(None).cast("double")),
            report["metrics"].select(F.lit("metrics"), "metric", F.lit(None).cast("double")),
            report["window"].select(F.lit("window"), F.col("start_date").cast("string"), F.lit(None).cast("double")),
            *[kpis.select(F.lit("kpis"), F.lit(c), F.col(c).cast("double")) for c in kpis.columns],
            *[change.select(F.lit("change"), F.lit(c), F.col(c).cast("double")) for c in change.columns],
        ]
        return tables.stage(_rounded(reduce(DataFrame.union, frames)), "usage-report")


def usage_mom(spark, sf_dir):
    return _rounded(ops.month_over_month(_user_days(spark, sf_dir), NEXT_MONTH))


def default_usage_window(spark, sf_dir):
    return ops.default_window(_user_days(spark, sf_dir))


def jobs_table(spark, sf_dir):
    table = ops.jobs_table(_facts(spark, sf_dir))
    return _rounded(table.withColumn("job_creation_dt", F.col("job_creation_dt").cast("timestamp_ntz")))


def kpi_value_label(spark, sf_dir):
    """The figures of each user and day, labelled by the name of their metric."""
    days = ops.user_day(_facts(spark, sf_dir))
    queries = F.col("number_of_queries")
    metrics = {
        "total_number_of_queries": (queries.cast("double"), True),
        "average_USD_cost_per_query": (F.try_divide("total_query_cost_usd", queries), False),
        "average_data_bill_per_query": (F.try_divide("total_gigabytes_billed", queries), False),
        "current_month_free_tier_used": (F.col("total_gigabytes_billed") / 1000 * 100, False),
        "current_gb_consumed": (F.col("total_gigabytes_billed"), False),
        "slot_seconds": (F.col("total_slot_seconds"), False),
    }
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("metric"), F.round(v, 6).alias("value"), F.lit(whole).alias("whole"))
            for k, (v, whole) in metrics.items()
        ]
    )
    figures = days.select("project_id", "job_created_date", "user_email", F.inline(rows))
    return figures.select(
        "project_id",
        "job_created_date",
        "user_email",
        "metric",
        labels.kpi_label(F.col("metric"), F.col("value"), F.col("whole")).alias("label"),
    )


QUERIES = {
    "rolling_distinct_users": rolling_distinct_users,
    "usage_report_csv": usage_report_csv,
    "usage_report_frames": usage_report_frames,
    "job_time_parts": job_time_parts,
    "job_unit_conversion": job_unit_conversion,
    "job_cost": job_cost,
    "job_rolling_window": job_rolling_window,
    "user_day_usage": user_day_usage,
    "usage_filter": usage_filter,
    "jobs_over_gb": jobs_over_gb,
    "daily_metric_series": daily_metric_series,
    "usage_kpis": usage_kpis,
    "usage_mom": usage_mom,
    "default_usage_window": default_usage_window,
    "jobs_table": jobs_table,
    "kpi_value_label": kpi_value_label,
}

_USERS_SQL = ", ".join(f"'{u}'" for u in USERS)

_USER_DAY_COLUMNS = """project_id, job_created_date, user_email, number_of_queries,
  round(total_query_seconds, 7) AS total_query_seconds, round(total_slot_seconds, 7) AS total_slot_seconds,
  round(total_gigabytes_processed, 7) AS total_gigabytes_processed,
  round(total_gigabytes_billed, 7) AS total_gigabytes_billed,
  round(total_query_cost_usd, 7) AS total_query_cost_usd"""

_REPORT_SQL = f"""job_created_date BETWEEN DATE '{REPORT_RANGE[0]}' AND DATE '{REPORT_RANGE[1]}'"""

ORACLE = {
    "rolling_distinct_users": with_cte(V_FACTS)
    + """SELECT d.job_created_date AS end_date, count(DISTINCT f.user_email) AS distinct_users
FROM (SELECT DISTINCT job_created_date FROM v_facts WHERE user_email IS NOT NULL) d
JOIN v_facts f ON f.job_created_date BETWEEN d.job_created_date - 6 AND d.job_created_date GROUP BY ALL""",
    "usage_report_csv": with_cte(V_FACTS)
    + f"""SELECT job_creation_dt, project_id, user_email, job_id, job_type, statement_type, priority, cache_hit,
  round(total_slot_seconds, 7) AS total_slot_seconds, round(total_gigabytes_billed, 7) AS total_gigabytes_billed,
  round(query_cost_usd, 7) AS query_cost_usd
FROM v_facts WHERE {_REPORT_SQL} AND user_email IN ({_USERS_SQL}) AND total_gigabytes_billed >= 20.0""",
    "usage_report_frames": with_cte(V_FACTS)
    + f""", chosen AS (SELECT * FROM v_user_day WHERE {_REPORT_SQL} AND user_email IN ({_USERS_SQL})),
sums AS (
  SELECT sum(number_of_queries) AS q, count(DISTINCT user_email) AS u, sum(total_query_cost_usd) AS c,
         sum(total_gigabytes_billed) AS g FROM chosen),
month AS (
  SELECT coalesce(sum(total_gigabytes_billed) FILTER (job_created_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'), 0) AS cur,
         coalesce(sum(total_gigabytes_billed) FILTER (job_created_date BETWEEN DATE '2023-12-01' AND DATE '2023-12-31'), 0) AS prev
  FROM v_user_day),
frames AS (
  SELECT 'series' AS frame, job_created_date::VARCHAR AS a, sum(total_gigabytes_billed) AS v FROM chosen GROUP BY job_created_date
  UNION ALL SELECT DISTINCT 'users', user_email, NULL::DOUBLE FROM v_user_day
  UNION ALL SELECT 'metrics', unnest(['number_of_queries', 'total_gigabytes_billed', 'total_gigabytes_processed',
    'total_query_cost_usd', 'total_query_seconds', 'total_slot_seconds']), NULL
  UNION ALL SELECT 'window', (max(job_created_date) - 60)::VARCHAR, NULL FROM v_user_day
  UNION ALL SELECT 'kpis', 'total_number_of_queries', q FROM sums
  UNION ALL SELECT 'kpis', 'distinct_users', u FROM sums
  UNION ALL SELECT 'kpis', 'average_usd_cost_per_query', c / q FROM sums
  UNION ALL SELECT 'kpis', 'average_data_bill_per_query', g / q FROM sums
  UNION ALL SELECT 'kpis', 'current_month_free_tier_used', cur / 1000 * 100 FROM month
  UNION ALL SELECT 'change', 'current_month_gb_consumed', cur FROM month
  UNION ALL SELECT 'change', 'previous_month_gb_consumed', prev FROM month
  UNION ALL SELECT 'change', 'percentage_difference', CASE WHEN prev <> 0 THEN (cur - prev) / prev * 100 ELSE 0 END FROM month)
SELECT frame, a, round(v, 7) AS v FROM frames""",
    "job_time_parts": with_cte(V_FACTS)
    + "SELECT job_id, job_creation_dt, job_created_date, job_created_month FROM v_facts",
    "job_unit_conversion": with_cte(V_FACTS)
    + """SELECT job_id, total_query_ms, round(total_query_seconds, 7) AS total_query_seconds,
  round(total_slot_seconds, 7) AS total_slot_seconds,
  round(total_megabytes_processed, 7) AS total_megabytes_processed,
  round(total_gigabytes_processed, 7) AS total_gigabytes_processed,
  round(total_megabytes_billed, 7) AS total_megabytes_billed,
  round(total_gigabytes_billed, 7) AS total_gigabytes_billed FROM v_facts""",
    "job_cost": with_cte(V_FACTS)
    + "SELECT job_id, total_bytes_billed, round(query_cost_usd, 7) AS query_cost_usd FROM v_facts",
    "job_rolling_window": with_cte(V_FACTS)
    + """SELECT job_id, user_email, end_time FROM v_facts
WHERE CAST(end_time AS DATE) BETWEEN DATE '2025-01-15' - 365 AND DATE '2025-01-15'""",
    "user_day_usage": with_cte(V_FACTS)
    + f"SELECT {_USER_DAY_COLUMNS} FROM v_user_day ORDER BY job_created_date, project_id, user_email NULLS FIRST",
    "usage_filter": with_cte(V_FACTS)
    + f"""SELECT {_USER_DAY_COLUMNS} FROM v_user_day
WHERE job_created_date BETWEEN DATE '{START}' AND DATE '{END}' AND user_email IN ({_USERS_SQL})""",
    "jobs_over_gb": with_cte(V_FACTS)
    + """SELECT job_id, user_email, round(total_gigabytes_billed, 7) AS total_gigabytes_billed
FROM v_facts WHERE total_gigabytes_billed >= 25.0""",
    "daily_metric_series": with_cte(V_FACTS)
    + """SELECT job_created_date, round(sum(total_query_cost_usd), 7) AS total_query_cost_usd
FROM v_user_day GROUP BY ALL""",
    "usage_kpis": with_cte(V_FACTS)
    + f""", v_flagged AS (
  SELECT *, job_created_date BETWEEN DATE '{START}' AND DATE '{END}' AND coalesce(user_email IN ({_USERS_SQL}), false) AS chosen,
         job_created_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AS this_month
  FROM v_user_day
)
SELECT CAST(sum(number_of_queries) FILTER (chosen) AS BIGINT) AS total_number_of_queries,
  count(DISTINCT user_email) FILTER (chosen) AS distinct_users,
  round(sum(total_query_cost_usd) FILTER (chosen) / nullif(sum(number_of_queries) FILTER (chosen), 0), 7)
    AS average_usd_cost_per_query,
  round(sum(total_gigabytes_billed) FILTER (chosen) / nullif(sum(number_of_queries) FILTER (chosen), 0), 7)
    AS average_data_bill_per_query,
  round(sum(total_gigabytes_billed) FILTER (this_month) / 1000 * 100, 7) AS current_month_free_tier_used
FROM v_flagged""",
    "usage_mom": with_cte(V_FACTS)
    + """, v_months AS (
  SELECT coalesce(sum(total_gigabytes_billed) FILTER (job_created_date BETWEEN DATE '2024-02-01' AND DATE '2024-02-29'), 0) AS cur,
         coalesce(sum(total_gigabytes_billed) FILTER (job_created_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'), 0) AS prev
  FROM v_user_day
)
SELECT round(cur, 7) AS current_month_gb_consumed, round(prev, 7) AS previous_month_gb_consumed,
  CASE WHEN prev <> 0 THEN round((cur - prev) / prev * 100, 7) ELSE 0 END AS percentage_difference
FROM v_months""",
    "default_usage_window": with_cte(V_FACTS)
    + """SELECT max(job_created_date) - 60 AS start_date, max(job_created_date) AS end_date,
  min(job_created_date) AS min_date_allowed, max(job_created_date) AS max_date_allowed FROM v_user_day""",
    "jobs_table": with_cte(V_FACTS)
    + """SELECT job_creation_dt, project_id, user_email, job_id, job_type, statement_type, priority, cache_hit,
  round(total_slot_seconds, 7) AS total_slot_seconds, round(total_gigabytes_billed, 7) AS total_gigabytes_billed,
  round(query_cost_usd, 7) AS query_cost_usd
FROM v_facts ORDER BY job_creation_dt DESC, job_id""",
    "kpi_value_label": with_cte(V_FACTS)
    + """SELECT project_id, job_created_date, user_email, m.metric AS metric,
  CASE m.metric
    WHEN 'total_number_of_queries' THEN format('{:,}', number_of_queries)
    WHEN 'average_USD_cost_per_query' THEN '$' || format('{:,.2f}', round(total_query_cost_usd / number_of_queries, 6))
    WHEN 'average_data_bill_per_query' THEN format('{:,.3f}', round(total_gigabytes_billed / number_of_queries, 6)) || ' GB'
    WHEN 'current_month_free_tier_used' THEN format('{:.2f}', round(total_gigabytes_billed / 1000 * 100, 6)) || '%'
    WHEN 'current_gb_consumed' THEN format('{:.1f}', round(total_gigabytes_billed, 6)) || 'GB'
    ELSE format('{:,.2f}', round(total_slot_seconds, 6)) END AS label
FROM v_user_day, (SELECT unnest(['total_number_of_queries', 'average_USD_cost_per_query', 'average_data_bill_per_query',
  'current_month_free_tier_used', 'current_gb_consumed', 'slot_seconds']) AS metric) m""",
}
