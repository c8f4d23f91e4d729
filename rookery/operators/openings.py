"""Statistics over a weekly openings table.

The aggregates drop groups with a NULL key and sum NULL counts as zero, and a
minimum number of games is applied after aggregation, strictly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions import labels

COUNTS = ("total_games", "white_win_count", "black_win_count")
COLORS = ("white", "black")

# Fixed value: bins of the win-rate histogram and points of the fitted curve.
HISTOGRAM_BINS = 10
CURVE_POINTS = 200


# --- building and filtering -------------------------------------------------


def week_of(day: Column, week_offset_days: int = 0) -> Column:
    """First day of a day's week: Monday, or ``week_offset_days`` later."""
    shifted = F.date_sub(day, week_offset_days)
    return F.date_add(F.to_date(F.date_trunc("week", shifted)), week_offset_days)


def build_weekly_openings(
    games: DataFrame,
    archetypes: DataFrame | None = None,
    week_offset_days: int = 0,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Games to weekly counts per time class and opening archetype.

    With ``start`` and ``end`` only weeks that begin in that range are counted
    (C1), and only their days are read: the range is also put on the game date, where it reaches the scan.

    ``archetypes`` maps ``opening`` to ``opening_archetype``; an opening it lacks
    gets NULL, and without a mapping the opening is its own archetype.  Weeks
    start on Monday, ``week_offset_days`` later if given (-1: Sunday).  Games are
    counted per opening first, so the mapping is joined to counts, not to games.
    """
    week_start = week_of(F.col("game_date"), week_offset_days)
    if start is not None and end is not None:
        first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
        games = games.where(F.col("game_date").between(first, F.date_add(last, 6)) & week_start.between(first, last))
    counts = games.groupBy(week_start.alias("week_start"), "time_class", "opening").agg(
        F.count(F.lit(1)).alias("total_games"),
        F.count_if(F.col("white.result") == "win").alias("white_win_count"),
        F.count_if(F.col("black.result") == "win").alias("black_win_count"),
    )
    if archetypes is None:
        return counts.withColumnRenamed("opening", "opening_archetype")
    mapping = archetypes.groupBy("opening").agg(F.min("opening_archetype").alias("opening_archetype"))
    return (
        counts.join(mapping, "opening", "left")
        .groupBy("week_start", "time_class", "opening_archetype")
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
    )


def week_range(weekly: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Weeks from ``start`` to ``end``, both included."""
    return weekly.where(F.col("week_start").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def dimension_filter(
    weekly: DataFrame,
    time_class: str | Sequence[str] | None = None,
    openings: Sequence[str] | None = None,
) -> DataFrame:
    """Chosen openings and time classes; nothing chosen or ``all`` keeps every row."""
    if openings:
        weekly = weekly.where(F.col("opening_archetype").isin(list(openings)))
    if time_class and time_class != "all":
        chosen = [time_class] if isinstance(time_class, str) else list(time_class)
        weekly = weekly.where(F.col("time_class").isin(chosen))
    return weekly


def min_games(counts: DataFrame, minimum: int | None) -> DataFrame:
    """Groups with more than ``minimum`` games."""
    return counts if minimum is None else counts.where(F.col("total_games") > minimum)


# --- aggregates ---------------------------------------------------------------


def add_win_pct(counts: DataFrame, with_labels: bool = False) -> DataFrame:
    """Win percentages of both colours, optionally with their labels."""
    for color in COLORS:
        pct = labels.win_pct(F.col(f"{color}_win_count"), F.col("total_games"))
        counts = counts.withColumn(f"{color}_win_pct", pct)
    if with_labels:
        for color in COLORS:
            counts = counts.withColumn(f"{color}_win_pct_str", labels.pct_label(F.col(f"{color}_win_pct")))
    return counts


def _sum_counts(weekly: DataFrame, keys: Sequence[str], minimum: int | None) -> DataFrame:
    for key in keys:
        weekly = weekly.where(F.col(key).isNotNull())
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]
    return min_games(weekly.groupBy(*keys).agg(*sums), minimum)


def weekly_opening(weekly: DataFrame, minimum: int | None = None) -> DataFrame:
    """Counts per week and opening."""
    return _sum_counts(weekly, ["week_start", "opening_archetype"], minimum)


def timeclass_opening(weekly: DataFrame, minimum: int | None = None) -> DataFrame:
    """Counts and win rates per time class and opening."""
    return add_win_pct(_sum_counts(weekly, ["time_class", "opening_archetype"], minimum))


def by_opening(weekly: DataFrame, minimum: int | None = None) -> DataFrame:
    """Counts and win rates per opening (E5)."""
    return add_win_pct(_sum_counts(weekly, ["opening_archetype"], minimum))


#: The three aggregates of the report, by the number that the grouping gives them.
LEVELS = {
    2: ("week_start", "opening_archetype"),
    4: ("time_class", "opening_archetype"),
    6: ("opening_archetype",),
}


def grouped_counts(weekly: DataFrame) -> DataFrame:
    """Counts of all three aggregates (E3, E4, E5) from one pass over the rows, told apart by ``level``."""
    keys = ("week_start", "time_class", "opening_archetype")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]
    sets = weekly.where("opening_archetype IS NOT NULL").groupingSets(LEVELS.values(), *keys)
    counts = sets.agg(F.grouping_id().cast("int").alias("level"), *sums)
    # A row whose own week or time class is NULL is no group of that aggregate.
    lacks = F.lit(False)
    for level, held in LEVELS.items():
        for key in held:
            lacks = lacks | ((F.col("level") == level) & F.col(key).isNull())
    return counts.where(~lacks)


def at_level(grouped: DataFrame, keys: Sequence[str], minimum: int | None = None, with_pct: bool = True) -> DataFrame:
    """One aggregate of :func:`grouped_counts`, with win rates if asked."""
    level = {held: number for number, held in LEVELS.items()}[tuple(keys)]
    counts = min_games(grouped.where(F.col("level") == level).select(*keys, *COUNTS), minimum)
    return add_win_pct(counts) if with_pct else counts


def weekly_totals(weekly_openings: DataFrame, metric: str = "total_games") -> DataFrame:
    """Sum of a metric per week over the openings that passed their threshold."""
    return weekly_openings.groupBy("week_start").agg(F.coalesce(F.sum(metric), F.lit(0)).alias(metric))


def distinct_dimensions(
    rows: DataFrame,
    dimensions: Sequence[str],
    with_all: Sequence[str] = (),
) -> DataFrame:
    """Distinct non-NULL values of each dimension with their labels.

    Sorting by ``dimension, sort_rank, value`` puts the optional ``all`` entry
    first.  All dimensions come out of one scan.
    """
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions])
    values = (
        rows.groupBy(*dimensions)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.inline(pairs))
        .where("value IS NOT NULL")
        .distinct()
        .select("dimension", F.lit(1).alias("sort_rank"), "value", labels.prettify(F.col("value")).alias("label"))
    )
    if with_all:
        spark = rows.sparkSession
        entries = [(d, 0, "all", "All") for d in with_all]
        values = values.unionByName(
            spark.createDataFrame(entries, "dimension string, sort_rank int, value string, label string")
        )
    return values


# --- report figures -----------------------------------------------------------


def top_openings(counts: DataFrame, n: int = 10) -> DataFrame:
    """Most played openings; ties go to the smaller name (F1)."""
    return counts.orderBy(F.desc("total_games"), "opening_archetype").limit(n)


def opening_kpis(counts: DataFrame) -> DataFrame:
    """Most and least played, best and worst win rate per colour: kpi, opening, value.

    Openings without games have no win rate and are passed over; ties go to the
    smaller name.
    """
    # A row is the minimum of (-value, name) or (value, name).
    name = F.col("opening_archetype")

    def extreme(metric: str, highest: bool) -> Column:
        value = F.col(metric).cast("double")
        rank = F.struct((-value if highest else value).alias("rank"), name.alias("opening"))
        best = F.min(F.when(value.isNotNull(), rank))
        shown = -best["rank"] if highest else best["rank"]
        return F.struct(best["opening"].alias("opening"), shown.alias("value"))

    tiles = {
        "most_played_opening": extreme("total_games", True),
        "least_played_opening": extreme("total_games", False),
        "highest_win_pct_as_white": extreme("white_win_pct", True),
        "highest_win_pct_as_black": extreme("black_win_pct", True),
        "lowest_win_pct_as_white": extreme("white_win_pct", False),
        "lowest_win_pct_as_black": extreme("black_win_pct", False),
    }
    rows = counts.agg(*[tile.alias(kpi) for kpi, tile in tiles.items()]).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("kpi"), F.col(k)["opening"].alias("opening"), F.col(k)["value"].alias("value"))
                    for k in tiles
                ]
            )
        )
    )
    return rows.where("opening IS NOT NULL")


def opening_hierarchy(
    weekly: DataFrame,
    metric: str = "total_games",
    include_undefined: bool = False,
) -> DataFrame:
    """Metric of ``All`` and of each opening below it.

    Rows with a NULL opening are left out, or counted as ``Undefined`` (B23).
    """
    if include_undefined:
        weekly = weekly.withColumn("opening_archetype", labels.or_undefined(F.col("opening_archetype")))
    else:
        weekly = weekly.where("opening_archetype IS NOT NULL")
    total = F.coalesce(F.sum(metric), F.lit(0)).alias(metric)
    is_root = F.grouping("opening_archetype") == 1
    return (
        weekly.rollup("opening_archetype")
        .agg(is_root.alias("is_root"), total)
        .select(
            F.when(F.col("is_root"), "All").otherwise(F.col("opening_archetype")).alias("node"),
            F.when(~F.col("is_root"), "All").alias("parent"),
            metric,
        )
    )


def _win_pct_column(color: str | None) -> str:
    color = color or "white"
    if color not in COLORS:
        raise ValueError(f"color must be one of {COLORS}")
    return f"{color}_win_pct"


def win_pct_stats(counts: DataFrame, color: str | None = None) -> DataFrame:
    """Mean, sample standard deviation, range and number of win rates."""
    pct = F.col(_win_pct_column(color))
    return counts.agg(
        F.avg(pct).alias("mean_pct"),
        F.stddev_samp(pct).alias("std_pct"),
        F.min(pct).alias("min_pct"),
        F.max(pct).alias("max_pct"),
        F.count(pct).alias("n_openings"),
    )


def win_pct_histogram(counts: DataFrame, color: str | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Non-empty bins of equal width with their count and density.

    The range comes from a scalar subquery over the same rows, so nothing is
    joined; the last bin includes the maximum.
    """
    pct = F.col(_win_pct_column(color))
    stats = win_pct_stats(counts, color)
    low, high, n = (stats.select(c).scalar() for c in ("min_pct", "max_pct", "n_openings"))
    width = (high - low) / bins
    position = F.when(high == low, 1).otherwise(F.least(F.width_bucket(pct, low, high, F.lit(bins)), F.lit(bins)))
    return (
        counts.where(pct.isNotNull())
        .groupBy(position.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_openings"))
        .select(
            "bin",
            (low + width * (F.col("bin") - 1)).alias("bin_start"),
            (low + width * F.col("bin")).alias("bin_end"),
            "n_openings",
            F.try_divide(F.col("n_openings"), n * width).alias("density"),
        )
    )


def normal_curve(counts: DataFrame, color: str | None = None, points: int = CURVE_POINTS) -> DataFrame:
    """Normal density with the rates' mean and deviation, over their range."""
    stats = win_pct_stats(counts, color)
    step = (F.col("max_pct") - F.col("min_pct")) / (points - 1)
    z = F.try_divide(F.col("x") - F.col("mean_pct"), F.col("std_pct"))
    density = F.try_divide(F.exp(-z * z / 2), F.col("std_pct") * F.sqrt(2 * F.pi()))
    return (
        stats.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.col("min_pct") + step * F.col("point"))
        .select("point", "x", density.alias("density"))
    )


def win_pct_pivot(timeclass_counts: DataFrame, time_classes: Sequence[str] | None = None) -> DataFrame:
    """White win rate: one row per opening, one column per time class.

    Without a list, the time classes are those that the counts hold.
    """
    return (
        timeclass_counts.groupBy("opening_archetype")
        .pivot("time_class", list(time_classes) if time_classes is not None else None)
        .agg(F.first("white_win_pct"))
    )


def win_rate_points(counts: DataFrame, color: str | None = None) -> DataFrame:
    """Games against win rate of one colour per opening; none without games."""
    return counts.where(F.col("total_games") > 0).select(
        "opening_archetype", "total_games", F.col(_win_pct_column(color)).alias("win_pct")
    )
