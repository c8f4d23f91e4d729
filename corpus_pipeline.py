"""From raw documents to a training corpus in five stages, each an operator of ``rookery.llm``.

Every stage takes all that the stage before kept, is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm.mixing import mix
from rookery.llm.pieces import encode_pieces
from rookery.llm.quality_rules import quality_rules
from rookery.llm.simhash import one_of_each
from rookery.llm.suffix_dedup import remove_repeats
from rookery.llm.tables import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble a language of the corpus."""
    return quality_rules(docs).filter("kept").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 50 bytes that an earlier one holds; n_chars follows the text.

    A cut may part a character's bytes; what is left of it goes too.  A null text becomes empty.
    """
    found = remove_repeats(docs, with_text=True)
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return found.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids of every document of the mix, and whether its ids decode to its text."""
    import public_tokenizers

    found = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "row.doc_id",
        "row.source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", reject_by_rules),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can't state fingerprints, suffix arrays and piece encodings; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
