"""Rule filter by divergence from language references.

A document is held against the character classes and common words of every
language of the corpus, by Jensen-Shannon divergence; far from all of them it is not prose.

A reference is the median over blocks of a language's documents.  Exact and near copies share
their block, as it follows from the rare words of a text, so that a large group of copies moves one block, not the median.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm import textstats as ts
from rookery.llm.tables import quoted, row_of, staged, utf8, with_row


@dataclass(frozen=True)
class Rules:
    """Parameters of the filter; the same at every corpus size."""

    min_words: int = 50
    #: Percent of a text's words in repeated windows of three.
    max_repeat_percent: int = 50
    #: A common word makes up at least this share of its language's words.
    common_share: float = 0.005
    #: Blocks that a language's documents are dealt to; its reference is their median.
    blocks: int = 15
    #: Shorter texts are not judged by characters, or by words: their histograms are mostly chance.
    min_chars_judged: int = 200
    min_words_judged: int = 100
    #: Allowed divergence: a floor, and what chance adds, which falls with the number of words.
    max_char_divergence: float = 0.025
    char_allowance: float = 3.0
    max_word_divergence: float = 0.02
    word_allowance: float = 6.0


STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "classes array<long>, n_tokens long, common_ids array<int>, common_counts array<int>, block int"
)
#: Words that a block of the first pass counts before it reports.
BLOCK_WORDS = 1_000_000
#: Copies may make up this many times the other words of a language before a common word escapes the candidates.
DILUTION = 3


def common_words(docs: DataFrame, share: float, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Words that may make up ``share`` of a language's words, a superset: lang, word.

    Blocks of words report those above half the share within the block, and
    their size.  A word that a block holds back has at most half the share
    there, so a word above the share overall is among those whose reported
    count, with half the share of all other blocks, reaches it; at most
    2 / share words of a language do.  Documents without a language take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        sizes: Counter = Counter()

        def report() -> pa.RecordBatch:
            rows = [(lang, None, size, 0) for lang, size in sizes.items()]
            for lang, words in held.items():
                least = share / 2 * sizes[lang]
                rows += [(lang, w, n, sizes[lang]) for w, n in words.items() if n >= least]
            held.clear()
            sizes.clear()
            columns = list(zip(*rows)) or [[], [], [], []]
            kinds = (pa.string(), pa.binary(), pa.int64(), pa.int64())
            names = ("lang", "word", "n", "block")
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = data.translate(ts.FOLD).split()
                held.setdefault(lang, Counter()).update(words)
                sizes[lang] += len(words)
                if sizes.total() >= BLOCK_WORDS:
                    yield report()
        if sizes:
            yield report()

    lang, text = F.col(quoted(lang_column)), F.col(quoted(text_column))
    reports = docs.filter(lang.isNotNull()).select(lang.alias("lang"), text.alias("text"))
    counted = (
        reports.mapInArrow(run, "lang string, word binary, n long, block long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"), F.sum("block").alias("block"))
    )
    counted = staged(counted, "common-words")
    sizes = counted.filter(F.col("word").isNull()).select(F.col("lang").alias("_lang"), F.col("n").alias("total"))
    reach = F.col("n") + share / 2 * (F.col("total") - F.col("block"))
    return (
        counted.filter(F.col("word").isNotNull())
        .join(sizes, F.col("lang") == F.col("_lang"))
        .filter(reach >= share * F.col("total"))
        .select("lang", "word")
    )


Batches = Iterator[pa.RecordBatch]


def _counted(words: list[bytes], rules: Rules) -> Callable[[Batches], Batches]:
    """From batches of (row, text) to batches of row and the counts of each text."""
    index = {word: place for place, word in enumerate(words)}
    symbol_bytes = list(ts.SYMBOLS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in utf8(batch.column(1)):
                tokens = data.split()
                bytes_held = ts.byte_counts(data)
                classes = ts.class_counts(bytes_held)
                n = len(tokens)
                repeats = ts.covered_words(ts.repeated_windows(ts.word_ids(tokens)), n)
                folded = data.translate(ts.FOLD).split()
                places = [i for i in map(index.get, folded) if i is not None]
                ids, counts = np.unique(np.array(places, np.int32), return_counts=True)
                rare = set(tokens).difference(index) or (data,)
                failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
                rows.append(
                    (
                        n,
                        int(classes.sum() - classes[3]),
                        int(bytes_held[symbol_bytes].sum()),
                        ts.duplicate_lines(data),
                        repeats,
                        failed,
                        classes,
                        len(folded),
                        ids,
                        counts.astype(np.int32),
                        min(map(crc32, rare)) % rules.blocks,
                    )
                )
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.list_(pa.int64()), pa.int64()] + [pa.list_(pa.int32())] * 2
            kinds.append(pa.int32())
            columns = list(zip(*rows)) or [[]] * len(kinds)
            names = ["row", *(c.split()[0] for c in STATS.split(", "))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    return run


def _carried(docs: DataFrame, keep: tuple[str, ...], text_column: str) -> DataFrame:
    return docs.select(row_of(docs, keep), F.col(quoted(text_column)).alias("text"))


def text_statistics(
    docs: DataFrame, words: list[bytes], rules: Rules, keep: tuple[str, ...], text_column: str = "text"
) -> DataFrame:
    """row (the columns of ``keep``) and the counts of each text, one pass."""
    rows = _carried(docs, keep, text_column)
    return rows.mapInArrow(_counted(words, rules), with_row(rows, STATS))


@dataclass(frozen=True)
class Reference:
    """Histograms of one language: character classes; common words and, last, all others."""

    lang: str
    classes: np.ndarray
    word_ids: np.ndarray
    words: np.ndarray


def references(stats: DataFrame, n_common: int, rules: Rules, lang_field: str = "row.lang") -> list[Reference]:
    """A reference for each language, from all its documents that pass the base rules.

    Shares are medians over the blocks.  What comes back to the driver is bounded by languages x
    blocks x (classes + common words).
    """
    good = stats.filter(~F.col("base_failed") & F.col(lang_field).isNotNull()).withColumn("_lang", F.col(lang_field))
    by = ("_lang", "block")
    class_sums = good.select(*by, F.posexplode("classes").alias("id", "n")).groupBy(*by, "id").agg(F.sum("n"))
    totals = {(r[0], r[1]): r[2] for r in good.groupBy(*by).agg(F.sum("n_tokens")).collect()}
    pairs = good.select(*by, F.explode(F.arrays_zip("common_ids", "common_counts")).alias("p"))
    word_sums = pairs.groupBy(*by, "p.common_ids").agg(F.sum("p.common_counts"))
    classes = {key: np.zeros(len(ts.CLASSES)) for key in totals}
    words = {key: np.zeros(n_common) for key in totals}
    for target, rows in ((classes, class_sums.collect()), (words, word_sums.collect())):
        for lang, block, place, n in rows:
            target[lang, block][place] = n
    found = []
    for lang in sorted({lang for lang, _ in totals}):
        held = [key for key in sorted(totals) if key[0] == lang and totals[key]]
        if not held:
            continue
        shares = np.median([words[key] / totals[key] for key in held], axis=0)
        ids = np.flatnonzero(shares >= rules.common_share)
        middle = np.median([classes[key] / classes[key].sum() for key in held], axis=0)
        rest = max(1 - shares[ids].sum(), 0.0)
        found.append(Reference(lang, middle / middle.sum(), ids, np.append(shares[ids], rest)))
    return found


def _entropy(p: np.ndarray) -> np.ndarray:
    return -(p * np.log2(np.where(p > 0, p, 1))).sum(-1)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (0 to 1) of each row of ``p`` from ``q``."""
    return np.clip(_entropy((p + q) / 2) - (_entropy(p) + _entropy(q)) / 2, 0, 1)


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "nearest_lang string, char_divergence double, word_divergence double, kept boolean"
)


def _judged(refs: list[Reference], rules: Rules, n_common: int) -> Callable[[Batches], Batches]:
    """From batches of counts to batches of verdicts; divergences are null where a text is too short for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                n = batch.num_rows
                n_words, failed, tokens = (
                    batch.column(k).to_numpy(zero_copy_only=False) for k in ("n_words", "base_failed", "n_tokens")
                )
                classes = np.array(batch.column("classes").to_pylist(), float).reshape(n, len(ts.CLASSES))
                ids, counts = batch.column("common_ids"), batch.column("common_counts")
                at = np.repeat(np.arange(n), ids.value_lengths().to_numpy(zero_copy_only=False))
                words = np.zeros((n, n_common))
                words[at, ids.flatten().to_numpy()] = counts.flatten().to_numpy()
                chars = classes.sum(1)
                by_char = (chars >= rules.min_chars_judged) & bool(refs)
                by_word = (tokens >= rules.min_words_judged) & bool(refs)
                nearest, char_div, word_div = np.full(n, -1), np.zeros(n), np.full(n, 2.0)
                class_share = classes / np.maximum(chars, 1)[:, None]
                for k, ref in enumerate(refs):
                    share = words[:, ref.word_ids] / np.maximum(tokens, 1)[:, None]
                    found = divergence(np.column_stack([share, 1 - share.sum(1)]), ref.words)
                    better = found < word_div
                    nearest[better], word_div[better] = k, found[better]
                    char_div[better] = divergence(class_share[better], ref.classes)
                most_char = rules.max_char_divergence + rules.char_allowance / np.maximum(n_words, 1)
                most_word = rules.max_word_divergence + rules.word_allowance / np.maximum(tokens, 1)
                strange = by_char & (char_div > most_char) | by_word & (word_div > most_word)
                counted = ("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
                columns = [
                    *(batch.column(c) for c in counted),
                    pa.array([refs[k].lang if k >= 0 else None for k in nearest], pa.string()),
                    pa.array(char_div, mask=~by_char),
                    pa.array(word_div, mask=~by_word),
                    pa.array(~failed.astype(bool) & ~strange),
                ]
                names = [*counted, "nearest_lang", "char_divergence", "word_divergence", "kept"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def quality_rules(
    docs: DataFrame,
    rules: Rules = Rules(),
    keep: tuple[str, ...] | None = None,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Verdict on every document: row (the columns of ``keep``, or all), the base counts, divergences, kept.

    Two passes over the texts: the first finds the common words of each
    language, the second counts (a third, if the texts themselves are kept).  Divergences are held against the nearest
    language by words, so a missing or wrong language tag does no harm to its document.

    Null text counts as empty and fails the base rules, as any text below
    ``min_words``.  Copies count as rows, but a group of copies, exact or near, is one of the blocks
    whose median is the reference.  Without any language tag there is no reference: the base
    rules alone decide.  An empty table gives no rows.  ``row`` keeps extra columns apart from the results' names.
    """
    share = rules.common_share / (1 + DILUTION)
    vocabulary = sorted({bytes(r.word) for r in common_words(docs, share, text_column, lang_column).collect()})
    kept_columns = tuple(keep or docs.columns)
    carried = kept_columns if lang_column in kept_columns else (*kept_columns, lang_column)
    narrow = tuple(c for c in carried if c != text_column)
    stats = staged(text_statistics(docs, vocabulary, rules, narrow, text_column), "quality-stats")
    refs = references(stats, len(vocabulary), rules, f"row.{quoted(lang_column)}")
    judge = _judged(refs, rules, len(vocabulary))
    if text_column not in kept_columns:
        return stats.mapInArrow(judge, with_row(stats, VERDICT))
    # Counting again costs less than a second copy of all texts; both steps share a worker.
    count = _counted(vocabulary, rules)
    rows = _carried(docs, carried, text_column)
    return rows.mapInArrow(lambda batches: judge(count(batches)), with_row(rows, VERDICT))
