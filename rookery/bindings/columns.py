"""Column functions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.bindings.views import table
from rookery.functions import games, labels, paths, periods


def url_last_component(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", paths.last_component(F.col("url")).alias("last_component"))


def opening_name(spark, sf_dir):
    """Page URLs taken as opening links."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", games.opening_name(F.translate("url", "_?", "--")).alias("opening"))


def prettify_label(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))
    return names.select("p_partkey", labels.prettify(F.col("name")).alias("label"))


def scope_label(spark, sf_dir):
    """The words of a part's name as the selection; none for one type, all for another."""
    kind = F.col("p_type")
    words = F.split("p_name", " ")
    selection = F.when(kind == "SMALL", F.array_append(words, "all")).when(kind != "ECONOMY", words)
    return table(spark, sf_dir, "part").select("p_partkey", labels.chart_title(selection, "Total Games Played").alias("title"))


def truncate_tail(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", labels.keep_tail(F.col("text")).alias("tail"))


def epoch_to_date(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", games.epoch_date(seconds).alias("game_date"))


def epoch_to_timestamp(spark, sf_dir):
    """Epoch seconds as wall clock in UTC and two hours east of it."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        games.epoch_timestamp(seconds).cast("timestamp_ntz").alias("utc_dt"),
        games.epoch_timestamp(seconds, "+02:00").cast("timestamp_ntz").alias("local_dt"),
    )


def month_list(spark, sf_dir):
    """Months of each order: from two months before its date to its date."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.explode(periods.month_list(F.add_months(day, -2), day)).alias("period")
    )


def run_window(spark, sf_dir):
    """The production window of a run on each order date."""
    window = periods.run_window(F.to_date("o_orderdate"), "PROD")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(F.array(window)))


def month_boundaries(spark, sf_dir):
    bounds = periods.month_boundaries(F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(F.array(bounds)))


QUERIES = {
    "url_last_component": url_last_component,
    "opening_name": opening_name,
    "prettify_label": prettify_label,
    "scope_label": scope_label,
    "truncate_tail": truncate_tail,
    "epoch_to_date": epoch_to_date,
    "epoch_to_timestamp": epoch_to_timestamp,
    "month_list": month_list,
    "run_window": run_window,
    "month_boundaries": month_boundaries,
}

_CAPITALISED = "list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:]))"

ORACLE = {
    "url_last_component": "SELECT page_id, string_split(url, '/')[-1] AS last_component FROM pages",
    "opening_name": "SELECT page_id, replace(translate(string_split(url, '/')[-1], '_?', '--'), '-', ' ') AS opening FROM pages",
    "prettify_label": f"SELECT p_partkey, array_to_string({_CAPITALISED}, ' ') AS label FROM part",
    "scope_label": f"""SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'All'
  ELSE array_to_string({_CAPITALISED}, ', ') END || ' | Total Games Played' AS title FROM part""",
    "truncate_tail": """SELECT doc_id, CASE WHEN length(text) > 1500 THEN '...(truncated)...' || chr(10) || right(text, 1500)
  ELSE text END AS tail FROM documents""",
    "epoch_to_date": "SELECT event_id, CAST(ts AS DATE) AS game_date FROM events",
    "epoch_to_timestamp": """SELECT event_id, date_trunc('second', ts) AS utc_dt,
  date_trunc('second', ts) + INTERVAL 2 HOUR AS local_dt FROM events""",
    "month_list": """SELECT o_orderkey, strftime(m, '%Y/%m') AS period
FROM (SELECT o_orderkey, day(o_orderdate) AS d, unnest(generate_series(
        date_trunc('month', o_orderdate) - INTERVAL 2 MONTH,
        date_trunc('month', o_orderdate) - CASE WHEN day(o_orderdate) > 1 THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END,
        INTERVAL 1 MONTH)) AS m FROM orders)""",
    "run_window": """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS start_date,
  CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS end_date,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y/%m') AS period FROM orders""",
    "month_boundaries": """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS current_month_start,
  last_day(o_orderdate) AS current_month_end,
  CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS previous_month_start,
  CAST(date_trunc('month', o_orderdate) AS DATE) - 1 AS previous_month_end FROM orders""",
}
