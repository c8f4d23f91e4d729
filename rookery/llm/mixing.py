"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.tables import quoted, row_of, staged, word_count

#: Sub-groups that one stratum of a source is numbered in: three hexadecimal digits of the document's key.
KEY_DIGITS = 3


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), limit: float = 3.0
) -> DataFrame:
    """Words each source should give: source, source_size, place, target.

    ``sizes`` holds one row per document with ``source`` and ``size``.  Sources
    are taken by code point, null last, and weigh ``weights`` in turn.  They
    share the size of all documents; a source stops at ``limit`` times its own
    size, and what it can't give goes to the others by weight.  The end of that
    resharing is one water level: in order of (limit x size / weight), a source
    is full while the level over the sources not yet full lies above its own.

    One row per source is kept in a single window, so it is bounded by the number of sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = Window.orderBy("_ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = totals.withColumn("place", (F.row_number().over(by_name) - 1).cast("long")).withColumn("_weight", weight)
    ranked = placed.withColumn("_ratio", limit * F.col("source_size") / F.col("_weight"))
    words_left = F.sum("source_size").over(everything) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    levelled = ranked.withColumn("_level", words_left / weight_left).withColumn(
        "_open", F.col("_level") <= F.col("_ratio")
    )
    level = F.max(F.when(F.col("_open"), F.col("_level"))).over(everything)
    target = F.when(F.col("_open"), level * F.col("_weight")).otherwise(limit * F.col("source_size"))
    return levelled.select("source", "source_size", "place", target.cast("double").alias("target"))


def _unit(text: Column) -> Column:
    """A number in [0, 1) that depends on a text alone."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix_copies(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    limit: float = 3.0,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """How often the mix takes each document: row, source, size, source_size, target, copies.

    ``row`` holds the columns named by ``keep`` (all, if None), so no column name can clash.

    Every document of a source is expected target / source_size times.  These
    expectations are summed along the source, one offset from [0, 1) is added,
    and a document is taken once per integer that its step crosses, hence
    floor or ceiling of the expectation, never over ``limit``.  Documents stand
    by size stratum (the size without all but its eight leading bits), then by
    a hash of their id: large and small ones are taken in proportion, and a
    source misses its target by little.

    The sum along a source is its rank times one number, and ranks come from
    three counts: documents of the source in lower strata, in the same stratum
    with a smaller key prefix, and within that prefix.  No task sees a whole
    source; a stratum that holds a third of all documents is numbered in 4,096 parts.

    Null text counts as empty, null source is a source of its own, null ids
    are hashed as empty text.  Equal ids are told apart by their text, equal
    rows are interchangeable.  An empty table gives an empty mix.
    """
    source, text = F.col(quoted(source_column)), F.col(quoted(text_column))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit(""))))
    spare = "greatest(length(bin(size)) - 8, 0)"
    rows = (
        docs.select(
            row_of(docs, keep or docs.columns),
            source.alias("source"),
            # The source as a key that is never null.
            F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")).alias("_source"),
            word_count(text).alias("size"),
            key.alias("_key"),
            F.xxhash64(text).alias("_same"),
        )
        .withColumn("_stratum", F.expr(f"shiftleft(shiftright(size, {spare}), {spare})"))
        .withColumn("_part", F.substring("_key", 1, KEY_DIGITS))
    )
    # The counts read a narrow copy; whole rows move once, to be numbered.
    sizes = staged(rows.select("source", "_source", "size", "_stratum", "_part"), "mix-sizes")
    cells = sizes.groupBy("_source", "_stratum", "_part").agg(F.count(F.lit(1)).alias("_n"))
    lower = Window.partitionBy("_source").orderBy("_stratum").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_source", "_stratum").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    strata = (
        sizes.groupBy("_source", "_stratum")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_source", "_stratum", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_below"))
    )
    starts = cells.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    targets = source_targets(sizes, weights, limit).withColumn(
        "_source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    )
    starts = starts.join(strata, ["_source", "_stratum"]).join(targets.drop("source"), "_source")
    cell = ["_source", "_stratum", "_part"]
    numbered = rows.withColumn("_row", F.row_number().over(Window.partitionBy(*cell).orderBy("_key", "_same")))
    # The starts grow with the corpus: never broadcast, and dealt like the numbered rows.
    ranked = numbered.join(starts.hint("merge"), cell)
    rank = F.col("_row") + F.col("_before") + F.col("_below")
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.concat(F.lit(seed), F.col("place").cast("string")))
    copies = F.floor(rank * step + offset) - F.floor((rank - 1) * step + offset)
    return ranked.select("row", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """The mixed documents, each row as often as :func:`mix_copies` says, with the columns of ``docs``."""
    return (
        mix_copies(docs, **options)
        .filter(F.col("copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("row.*")
    )
