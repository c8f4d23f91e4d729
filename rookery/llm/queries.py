"""The queries of this subpackage, each over its whole table, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm.languages import identify_languages, train_languages
from rookery.llm.lexical import rank_documents
from rookery.llm.licenses import license_sql, scan_licenses
from rookery.llm.mixing import mix_copies
from rookery.llm.neighbours import nearest_neighbours
from rookery.llm.pieces import encode_pieces
from rookery.llm.quality_model import score_quality, text_features, train_quality
from rookery.llm.quality_rules import quality_rules
from rookery.llm.simhash import near_duplicates
from rookery.llm.suffix_dedup import remove_repeats
from rookery.llm.tables import held_out, staged, table
from rookery.llm.token_files import read_documents, read_tokens, with_checksums, write_tokens
from rookery.llm.topk import top_inner_products
from rookery.llm.whitening import whiten
from rookery.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_copies(table(spark, sf_dir, "documents"), keep=("doc_id",))
    taken = F.col("size") * F.col("copies")
    return mixed.select("row.doc_id", "source", "size", "source_size", "target", "copies", taken.alias("taken"))


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
stratified AS (
  SELECT *, (size >> greatest(length(bin(size)) - 8, 0)) << greatest(length(bin(size)) - 8, 0) AS stratum FROM sized),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY stratum, k) AS n FROM stratified),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[place % 3 + 1] AS w FROM sources),
ratios AS (SELECT *, 3.0::DOUBLE * source_size / w AS ratio FROM weighed),
levels AS (
  SELECT *,
    (sum(source_size) OVER () - 3.0::DOUBLE * coalesce(sum(source_size) OVER before, 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM ratios WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, place,
    CASE WHEN level <= ratio THEN max(level) FILTER (WHERE level <= ratio) OVER () * w
         ELSE 3.0::DOUBLE * source_size END AS target
  FROM levels),
steps AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS step,
    ('0x' || substr(md5('mix' || place::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM targets),
taken AS (
  SELECT doc_id, r.source, size, source_size, target,
    (floor(n * step + u) - floor((n - 1) * step + u))::BIGINT AS copies
  FROM ranked r JOIN steps s ON r.source IS NOT DISTINCT FROM s.source)
SELECT *, size * copies AS taken FROM taken
"""


def op9_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every fiftieth vector with all others."""
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.uid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.uid <> c.uid WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), keep=("doc_id",)).select(
        "row.doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
        "nearest_lang",
        "char_divergence",
        "word_divergence",
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's ids lie in the token files, and their checksum, read back from the files."""
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, end_id=1)
    sums = with_checksums(read_tokens(spark, path)).withColumnsRenamed({"part": "_part", "row": "_row"})
    same = (F.col("part") == F.col("_part")) & (F.col("row") == F.col("_row"))
    return read_documents(spark, path).join(sums, same).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    found = scan_licenses(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("row.doc_id", *found.drop("row", "matches").columns)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels of four fifths of them."""
    stats = staged(text_features(table(spark, sf_dir, "documents"), keep=("doc_id",)), "text-features")
    labels = table(spark, sf_dir, "labels")
    model = train_quality(stats, labels.filter(~held_out(F.col("doc_id"), 5, 0)))
    return score_quality(stats, model).select(
        "row.doc_id",
        held_out(F.col("row.doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without strings of 50 bytes that an earlier one holds."""
    found = remove_repeats(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of what they decode to."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    found = encode_pieces(table(spark, sf_dir, "documents"), model, keep=("doc_id",))
    return found.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of the tagged ones."""
    docs = table(spark, sf_dir, "documents")
    apart = held_out(F.col("doc_id"), 3, 1)
    model = train_languages(docs.filter(~apart))
    found = identify_languages(docs, model, keep=("doc_id",))
    return found.select(
        "row.doc_id",
        held_out(F.col("row.doc_id"), 3, 1).alias("held_out"),
        "lang_pred",
        "score",
        F.size("mixture").alias("n_languages"),
    )


def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest found by inner product for every twentieth vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


OP12_SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS uid, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
totals AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc_terms),
tf AS (
  SELECT uid, doc_id, len(terms)::BIGINT AS n, term, count(*)::BIGINT AS tf
  FROM (SELECT uid, doc_id, terms, unnest(terms) AS term FROM doc_terms) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT row_number() OVER () AS item, item_id,
    unnest(list_distinct(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark),
weighed AS (
  SELECT item, item_id, term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM asked JOIN df USING (term), totals),
scored AS (
  SELECT item, item_id, uid, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM weighed JOIN tf USING (term), totals GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened coordinates of every vector."""
    return whiten(table(spark, sf_dir, "embeddings"), k=4, scale=256.0)


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_token_files": op2_token_files,
    "op3_license_scan": op3_license_scan,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_language_id": op7_language_id,
    "op8_simhash_near_duplicates": op8_simhash_near_duplicates,
    "op9_top_inner_products": op9_top_inner_products,
    "op10_quality_rules": op10_quality_rules,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_lexical_search": op12_lexical_search,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLE: dict[str, str] = {
    "op1_mix_sources": OP1_SQL,
    "op3_license_scan": license_sql(),
    "op9_top_inner_products": OP9_SQL,
    "op12_lexical_search": OP12_SQL,
}
