"""Opening statistics on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.bindings.views import V_WEEKLY, table, weekly, weekly_games, with_cte
from rookery.functions import labels
from rookery.operators import openings as ops
from rookery.plans.reports import opening_report
from rookery.sources.tables import stage

TIME_CLASSES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
START, END = "1996-01-01", "1999-12-31"
CHOSEN = ["Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6", "Brand#7"]
MIN_TOP = 100
MIN_REPORT = 1
REPORT_START, REPORT_END = dt.date(1996, 1, 1), dt.date(1999, 12, 31)
MIN_TOTAL = 2400
MIN_WEEKLY = 4


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, 9) for c in columns})


def opening_report_frames(spark, sf_dir):
    """Frames of the opening report, one below the other: frame, two names, a number and a figure."""
    shown = {
        "weekly_opening": ("week_start", "opening_archetype", "total_games", "white_win_count"),
        "timeclass_opening": ("time_class", "opening_archetype", "total_games", "white_win_pct"),
        "opening": ("opening_archetype", None, "total_games", "black_win_pct"),
        "weekly_totals": ("week_start", None, "total_games", None),
        "hierarchy": ("node", "parent", "total_games", None),
        "top": ("opening_archetype", None, "total_games", "white_win_pct"),
        "points": ("opening_archetype", None, "total_games", "win_pct"),
        "kpis": ("kpi", "opening", None, "value"),
        "stats": (None, None, "n_openings", "mean_pct"),
        "dimensions": ("dimension", "value", "sort_rank", None),
    }
    base = weekly(spark, sf_dir)
    with opening_report(base, REPORT_START, REPORT_END, list(TIME_CLASSES[:4]), None, MIN_REPORT, "white") as report:
        heat = report["heat_map"]
        report["heat"] = heat.unpivot("opening_archetype", heat.columns[1:], "time_class", "win_pct").where("win_pct IS NOT NULL")
        shown["heat"] = ("opening_archetype", "time_class", None, "win_pct")
        frames = None
        for name, columns in shown.items():
            values = [F.lit(None) if c is None else F.col(c) for c in columns]
            kinds = ("string", "string", "bigint", "double")
            cells = [v.cast(k).alias(a) for v, k, a in zip(values, kinds, ("a", "b", "n", "v"))]
            frame = report[name].select(F.lit(name).alias("frame"), *cells)
            frames = frame if frames is None else frames.union(frame)
        return stage(_rounded(frames, "v"), "opening-report")


def _opening(spark, sf_dir, minimum=None):
    return ops.by_opening(weekly(spark, sf_dir), minimum)


def top10_openings(spark, sf_dir):
    base = ops.dimension_filter(weekly(spark, sf_dir, START, END), "all", None)
    return _rounded(ops.top_openings(ops.by_opening(base, MIN_TOP)), "white_win_pct", "black_win_pct")


def weekly_openings_build(spark, sf_dir):
    """Brands up to 20 belong to a family of two; the others are unmapped."""
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("opening")).distinct()
    number = F.regexp_extract("opening", r"(\d+)$", 1).cast("int")
    mapping = parts.where(number <= 20).select(
        "opening", F.concat(F.lit("Family "), F.floor(number / 2).cast("string")).alias("opening_archetype")
    )
    return ops.build_weekly_openings(weekly_games(spark, sf_dir), mapping)


def weekly_range(spark, sf_dir):
    return weekly(spark, sf_dir, START, END)


def dimension_filter(spark, sf_dir):
    return ops.dimension_filter(weekly(spark, sf_dir), ["1-URGENT", "3-MEDIUM"], CHOSEN)


def min_games_having(spark, sf_dir):
    return _rounded(_opening(spark, sf_dir, MIN_TOTAL), "white_win_pct", "black_win_pct")


def win_pct(spark, sf_dir):
    """Per weekly row rather than per aggregate."""
    return _rounded(ops.add_win_pct(weekly(spark, sf_dir)), "white_win_pct", "black_win_pct")


def win_pct_label(spark, sf_dir):
    counts = ops.add_win_pct(ops.weekly_opening(weekly(spark, sf_dir)), with_labels=True)
    return counts.select("week_start", "opening_archetype", "white_win_pct_str", "black_win_pct_str")


def fill_undefined(spark, sf_dir):
    named = labels.or_undefined(F.col("opening_archetype"))
    return weekly(spark, sf_dir).withColumn("opening_archetype", named)


def distinct_dimensions(spark, sf_dir):
    return ops.distinct_dimensions(
        weekly(spark, sf_dir), ["time_class", "opening_archetype"], with_all=["time_class"]
    ).orderBy("dimension", "sort_rank", "value")


def weekly_opening_agg(spark, sf_dir):
    return ops.weekly_opening(weekly(spark, sf_dir), MIN_WEEKLY)


def timeclass_opening_agg(spark, sf_dir):
    return _rounded(ops.timeclass_opening(weekly(spark, sf_dir)), "white_win_pct", "black_win_pct")


def opening_agg(spark, sf_dir):
    return _rounded(_opening(spark, sf_dir), "white_win_pct", "black_win_pct")


def weekly_total_series(spark, sf_dir):
    return ops.weekly_totals(ops.weekly_opening(weekly(spark, sf_dir), MIN_WEEKLY))


def opening_kpis(spark, sf_dir):
    return _rounded(ops.opening_kpis(_opening(spark, sf_dir)), "value")


def opening_rollup(spark, sf_dir):
    return ops.opening_hierarchy(weekly(spark, sf_dir), include_undefined=True)


def winpct_distribution_stats(spark, sf_dir):
    stats = ops.win_pct_stats(_opening(spark, sf_dir))
    return _rounded(stats, "mean_pct", "std_pct", "min_pct", "max_pct")


def winpct_histogram(spark, sf_dir):
    return _rounded(ops.win_pct_histogram(_opening(spark, sf_dir)), "bin_start", "bin_end", "density")


def normal_fit_curve(spark, sf_dir):
    return _rounded(ops.normal_curve(_opening(spark, sf_dir)), "x", "density")


def winpct_pivot(spark, sf_dir):
    pivot = ops.win_pct_pivot(ops.timeclass_opening(weekly(spark, sf_dir)))
    return _rounded(pivot, *[c for c in pivot.columns if c != "opening_archetype"])


def winrate_scatter(spark, sf_dir):
    return _rounded(ops.win_rate_points(_opening(spark, sf_dir), "black"), "win_pct")


QUERIES = {
    "opening_report_frames": opening_report_frames,
    "top10_openings": top10_openings,
    "weekly_openings_build": weekly_openings_build,
    "weekly_range": weekly_range,
    "dimension_filter": dimension_filter,
    "min_games_having": min_games_having,
    "win_pct": win_pct,
    "win_pct_label": win_pct_label,
    "fill_undefined": fill_undefined,
    "distinct_dimensions": distinct_dimensions,
    "weekly_opening_agg": weekly_opening_agg,
    "timeclass_opening_agg": timeclass_opening_agg,
    "opening_agg": opening_agg,
    "weekly_total_series": weekly_total_series,
    "opening_kpis": opening_kpis,
    "opening_rollup": opening_rollup,
    "winpct_distribution_stats": winpct_distribution_stats,
    "winpct_histogram": winpct_histogram,
    "normal_fit_curve": normal_fit_curve,
    "winpct_pivot": winpct_pivot,
    "winrate_scatter": winrate_scatter,
}

_SUMS = """CAST(coalesce(sum(total_games), 0) AS BIGINT) AS total_games,
  CAST(coalesce(sum(white_win_count), 0) AS BIGINT) AS white_win_count,
  CAST(coalesce(sum(black_win_count), 0) AS BIGINT) AS black_win_count"""

_V_OPENING = f"""v_sums AS (
  SELECT opening_archetype, {_SUMS} FROM v_weekly WHERE opening_archetype IS NOT NULL GROUP BY ALL
), v_opening AS (
  SELECT *, white_win_count / nullif(total_games, 0) * 100 AS white_win_pct,
            black_win_count / nullif(total_games, 0) * 100 AS black_win_pct FROM v_sums
)"""

_V_STATS = """v_stats AS (
  SELECT avg(white_win_pct) AS mean_pct, stddev_samp(white_win_pct) AS std_pct,
         min(white_win_pct) AS min_pct, max(white_win_pct) AS max_pct, count(white_win_pct) AS n_openings
  FROM v_opening
)"""

_ROUNDED = """opening_archetype, total_games, white_win_count, black_win_count,
  round(white_win_pct, 9) AS white_win_pct, round(black_win_pct, 9) AS black_win_pct"""

_V_WEEKLY_OPENING = f"""v_weekly_opening AS (
  SELECT week_start, opening_archetype, {_SUMS} FROM v_weekly
  WHERE opening_archetype IS NOT NULL GROUP BY ALL
)"""


def _kpi(name: str, metric: str, direction: str, shown: str | None = None) -> str:
    return f"""(SELECT '{name}' AS kpi, opening_archetype AS opening,
  round(CAST({shown or metric} AS DOUBLE), 9) AS value
  FROM v_opening WHERE {metric} IS NOT NULL ORDER BY {metric} {direction}, opening_archetype LIMIT 1)"""


_LISTED = ", ".join(f"'{c}'" for c in TIME_CLASSES[:4])
REPORT_SQL = (
    with_cte(V_WEEKLY)
    + f""", base AS (
  SELECT * FROM v_weekly WHERE week_start BETWEEN DATE '{REPORT_START}' AND DATE '{REPORT_END}' AND time_class IN ({_LISTED})
    AND opening_archetype IS NOT NULL),
wo AS (SELECT week_start, opening_archetype, sum(total_games) AS g, sum(white_win_count) AS w FROM base GROUP BY ALL HAVING g > {MIN_REPORT}),
tc AS (SELECT time_class, opening_archetype, sum(total_games) AS g, sum(white_win_count) / sum(total_games) * 100 AS w
  FROM base GROUP BY ALL HAVING g > {MIN_REPORT}),
op AS (SELECT opening_archetype AS o, sum(total_games) AS g, sum(white_win_count) / sum(total_games) * 100 AS w,
  sum(black_win_count) / sum(total_games) * 100 AS b FROM base GROUP BY ALL HAVING g > {MIN_REPORT}),
kpis AS (
  SELECT unnest(['most_played_opening', 'least_played_opening', 'highest_win_pct_as_white', 'highest_win_pct_as_black',
                 'lowest_win_pct_as_white', 'lowest_win_pct_as_black']) AS kpi,
    unnest([(SELECT o FROM op ORDER BY g DESC, o LIMIT 1), (SELECT o FROM op ORDER BY g, o LIMIT 1),
            (SELECT o FROM op ORDER BY w DESC, o LIMIT 1), (SELECT o FROM op ORDER BY b DESC, o LIMIT 1),
            (SELECT o FROM op ORDER BY w, o LIMIT 1), (SELECT o FROM op ORDER BY b, o LIMIT 1)]) AS opening,
    unnest([(SELECT max(g) FROM op)::DOUBLE, (SELECT min(g) FROM op)::DOUBLE, (SELECT max(w) FROM op), (SELECT max(b) FROM op),
            (SELECT min(w) FROM op), (SELECT min(b) FROM op)]) AS value),
frames AS (
  SELECT 'weekly_opening' AS frame, week_start::VARCHAR AS a, opening_archetype AS b, g AS n, w::DOUBLE AS v FROM wo
  UNION ALL SELECT 'timeclass_opening', time_class, opening_archetype, g, w FROM tc
  UNION ALL SELECT 'opening', o, NULL, g, b FROM op
  UNION ALL SELECT 'weekly_totals', week_start::VARCHAR, NULL, sum(g), NULL FROM wo GROUP BY week_start
  UNION ALL SELECT 'hierarchy', o, 'All', g, NULL FROM op
  UNION ALL SELECT 'hierarchy', 'All', NULL, coalesce(sum(g), 0), NULL FROM op
  UNION ALL (SELECT 'top', o, NULL, g, w FROM op ORDER BY g DESC, o LIMIT 10)
  UNION ALL SELECT 'points', o, NULL, g, w FROM op WHERE g > 0
  UNION ALL SELECT 'kpis', kpi, opening, NULL, value FROM kpis WHERE opening IS NOT NULL
  UNION ALL SELECT 'stats', NULL, NULL, count(w), avg(w) FROM op
  UNION ALL SELECT DISTINCT 'dimensions', 'time_class', time_class, 1, NULL::DOUBLE FROM v_weekly WHERE time_class IS NOT NULL
  UNION ALL SELECT DISTINCT 'dimensions', 'opening_archetype', opening_archetype, 1, NULL::DOUBLE
    FROM v_weekly WHERE opening_archetype IS NOT NULL
  UNION ALL SELECT 'dimensions', 'time_class', 'all', 0, NULL
  UNION ALL SELECT 'heat', opening_archetype, time_class, NULL, w FROM tc)
SELECT frame, a, b, n::BIGINT AS n, round(v, 9) AS v FROM frames"""
)

ORACLE = {
    "opening_report_frames": REPORT_SQL,
    "top10_openings": with_cte(V_WEEKLY)
    + f"""SELECT opening_archetype, total_games, white_win_count, black_win_count,
  round(white_win_count / nullif(total_games, 0) * 100, 9) AS white_win_pct,
  round(black_win_count / nullif(total_games, 0) * 100, 9) AS black_win_pct
FROM (SELECT opening_archetype, {_SUMS} FROM v_weekly
      WHERE opening_archetype IS NOT NULL AND week_start BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ALL)
WHERE total_games > {MIN_TOP}
ORDER BY total_games DESC, opening_archetype LIMIT 10""",
    "weekly_openings_build": """SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start,
  o_orderpriority AS time_class,
  CASE WHEN p_brand <> 'Brand#1' AND CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) <= 20
       THEN 'Family ' || (CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) // 2) END AS opening_archetype,
  CAST(count(*) AS BIGINT) AS total_games,
  CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS white_win_count,
  CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS black_win_count
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
GROUP BY ALL""",
    "weekly_range": with_cte(V_WEEKLY)
    + f"SELECT * FROM v_weekly WHERE week_start BETWEEN DATE '{START}' AND DATE '{END}'",
    "dimension_filter": with_cte(V_WEEKLY)
    + f"""SELECT * FROM v_weekly WHERE time_class IN ('1-URGENT', '3-MEDIUM')
AND opening_archetype IN ({", ".join(repr(c) for c in CHOSEN)})""",
    "min_games_having": with_cte(V_WEEKLY, _V_OPENING) + f"SELECT {_ROUNDED} FROM v_opening WHERE total_games > {MIN_TOTAL}",
    "win_pct": with_cte(V_WEEKLY)
    + """SELECT *, round(white_win_count / nullif(total_games, 0) * 100, 9) AS white_win_pct,
  round(black_win_count / nullif(total_games, 0) * 100, 9) AS black_win_pct FROM v_weekly""",
    "win_pct_label": with_cte(V_WEEKLY, _V_WEEKLY_OPENING)
    + """SELECT week_start, opening_archetype,
  printf('%.1f%%', white_win_count / nullif(total_games, 0) * 100) AS white_win_pct_str,
  printf('%.1f%%', black_win_count / nullif(total_games, 0) * 100) AS black_win_pct_str
FROM v_weekly_opening""",
    "fill_undefined": with_cte(V_WEEKLY)
    + "SELECT * REPLACE (coalesce(opening_archetype, 'Undefined') AS opening_archetype) FROM v_weekly",
    "distinct_dimensions": with_cte(V_WEEKLY)
    + """SELECT dimension, sort_rank, value, label FROM (
  SELECT DISTINCT 'time_class' AS dimension, CAST(1 AS INTEGER) AS sort_rank, time_class AS value,
    array_to_string(list_transform(string_split(time_class, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label
  FROM v_weekly
  UNION ALL
  SELECT DISTINCT 'opening_archetype', CAST(1 AS INTEGER), opening_archetype, opening_archetype FROM v_weekly
  WHERE opening_archetype IS NOT NULL
  UNION ALL
  SELECT 'time_class', CAST(0 AS INTEGER), 'all', 'All')
ORDER BY dimension, sort_rank, value""",
    "weekly_opening_agg": with_cte(V_WEEKLY, _V_WEEKLY_OPENING)
    + f"SELECT * FROM v_weekly_opening WHERE total_games > {MIN_WEEKLY}",
    "timeclass_opening_agg": with_cte(V_WEEKLY)
    + f"""SELECT *, round(white_win_count / nullif(total_games, 0) * 100, 9) AS white_win_pct,
  round(black_win_count / nullif(total_games, 0) * 100, 9) AS black_win_pct
FROM (SELECT time_class, opening_archetype, {_SUMS} FROM v_weekly
      WHERE opening_archetype IS NOT NULL AND time_class IS NOT NULL GROUP BY ALL)""",
    "opening_agg": with_cte(V_WEEKLY, _V_OPENING) + f"SELECT {_ROUNDED} FROM v_opening",
    "weekly_total_series": with_cte(V_WEEKLY, _V_WEEKLY_OPENING)
    + f"""SELECT week_start, CAST(sum(total_games) AS BIGINT) AS total_games
FROM v_weekly_opening WHERE total_games > {MIN_WEEKLY} GROUP BY ALL""",
    "opening_kpis": with_cte(V_WEEKLY, _V_OPENING)
    + " UNION ALL ".join(
        [
            _kpi("most_played_opening", "total_games", "DESC"),
            _kpi("least_played_opening", "total_games", "ASC"),
            _kpi("highest_win_pct_as_white", "white_win_pct", "DESC"),
            _kpi("highest_win_pct_as_black", "black_win_pct", "DESC"),
            _kpi("lowest_win_pct_as_white", "white_win_pct", "ASC"),
            _kpi("lowest_win_pct_as_black", "black_win_pct", "ASC"),
        ]
    ),
    "opening_rollup": with_cte(V_WEEKLY)
    + """SELECT CASE WHEN g = 1 THEN 'All' ELSE opening END AS node, CASE WHEN g = 0 THEN 'All' END AS parent, total_games
FROM (SELECT opening, grouping(opening) AS g, CAST(sum(total_games) AS BIGINT) AS total_games
      FROM (SELECT coalesce(opening_archetype, 'Undefined') AS opening, total_games FROM v_weekly)
      GROUP BY ROLLUP (opening))""",
    "winpct_distribution_stats": with_cte(V_WEEKLY, _V_OPENING, _V_STATS)
    + """SELECT round(mean_pct, 9) AS mean_pct, round(std_pct, 9) AS std_pct, round(min_pct, 9) AS min_pct,
  round(max_pct, 9) AS max_pct, n_openings FROM v_stats""",
    "winpct_histogram": with_cte(V_WEEKLY, _V_OPENING, _V_STATS)
    + """SELECT bin, round(min_pct + (max_pct - min_pct) / 10 * (bin - 1), 9) AS bin_start,
  round(min_pct + (max_pct - min_pct) / 10 * bin, 9) AS bin_end, count(*) AS n_openings,
  round(count(*) / (any_value(s.n_openings) * ((max_pct - min_pct) / 10)), 9) AS density
FROM (SELECT CAST(CASE WHEN max_pct = min_pct THEN 1
        ELSE least(floor((white_win_pct - min_pct) / ((max_pct - min_pct) / 10)) + 1, 10) END AS INTEGER) AS bin, s.*
      FROM v_opening, v_stats s WHERE white_win_pct IS NOT NULL) s
GROUP BY bin, min_pct, max_pct""",
    "normal_fit_curve": with_cte(V_WEEKLY, _V_OPENING, _V_STATS)
    + """SELECT point, round(x, 9) AS x,
  round(exp(-((x - mean_pct) / std_pct) * ((x - mean_pct) / std_pct) / 2) / (std_pct * sqrt(2 * pi())), 9) AS density
FROM (SELECT CAST(p AS INTEGER) AS point, min_pct + (max_pct - min_pct) / 199 * p AS x, mean_pct, std_pct
      FROM v_stats, (SELECT unnest(range(0, 200)) AS p))""",
    "winpct_pivot": with_cte(V_WEEKLY)
    + "SELECT opening_archetype, "
    + ", ".join(
        f"""round(sum(white_win_count) FILTER (time_class = '{t}')
  / nullif(sum(total_games) FILTER (time_class = '{t}'), 0) * 100, 9) AS "{t}\""""
        for t in TIME_CLASSES
    )
    + " FROM v_weekly WHERE opening_archetype IS NOT NULL GROUP BY ALL",
    "winrate_scatter": with_cte(V_WEEKLY, _V_OPENING)
    + """SELECT opening_archetype, total_games, round(black_win_pct, 9) AS win_pct
FROM v_opening WHERE total_games > 0""",
}
