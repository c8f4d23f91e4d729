"""Ranked lexical search without an index: an automaton of all item terms reads every document once.

The distinct terms of the items, each between guards, form an Aho-Corasick automaton that is sent to
every task.  A document, with one guard in place of every run of other characters, goes
through it, which gives the number of times it holds each term.  Those counts are kept;
collection statistics come from them, and in a second pass over the counts every term
adds its weight to the items that hold it.  A task keeps no more than the best documents of each item.

Items are dealt to parts of bounded size by a hash, one automaton each; a part reads the documents once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.tables import quoted, staged, utf8

# A term is a run of ASCII letters and digits and of all characters beyond ASCII; only A-Z fold.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Terms of a part: bytes over all its items, about 50 MB as an automaton; and its items.
PART_BYTES = 1 << 20
PART_ITEMS = 5_000
#: Characters that go through the automaton at once.
SLICE = 1 << 20
#: Scores (documents x items) held at once.
CELLS = 1 << 17
#: Parts that an item's candidates are ranked in before they meet.
SALTS = 32

COUNTS = "id long, n long, terms array<int>, counts array<int>"
SCORES = "h1 long, h2 long, doc_id long, score long"

_GUARD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Terms:
    """Distinct terms of a part's items, and for each term the items that hold it."""

    keys: np.ndarray
    terms: list[str]
    starts: np.ndarray
    items: np.ndarray

    @staticmethod
    def of(items: Iterable[tuple[int, int, list[str]]]) -> Terms:
        numbers: dict[str, int] = {}
        keys, held, owners = [], [], []
        for place, (h1, h2, terms) in enumerate(items):
            keys.append((h1, h2))
            for term in terms:
                held.append(numbers.setdefault(term, len(numbers)))
                owners.append(place)
        held = np.array(held, np.int64)
        order = np.argsort(held, kind="stable")
        starts = np.searchsorted(held[order], np.arange(len(numbers) + 1))
        return Terms(np.array(keys, np.int64).reshape(-1, 2), list(numbers), starts, np.array(owners, np.int64)[order])

    def automaton(self) -> ahocorasick.Automaton:
        """Automaton of the terms between guards; a match gives the term's number."""
        found = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            found.add_word(f" {term} ", number)
        found.make_automaton()
        return found


def _slices(data: bytes) -> Iterator[bytes]:
    """Pieces of guarded text, parted at guards only."""
    start = 0
    while len(data) - start > SLICE:
        stop = data.rfind(b" ", start, start + SLICE)
        stop = stop if stop > start else data.find(b" ", start + SLICE)
        if stop < 0:
            break
        yield data[start:stop]
        start = stop
    yield data[start:]


def count_terms(texts: Iterable[bytes], automaton: ahocorasick.Automaton, n_terms: int):
    """Terms of each text with repeats; text, term, occurrences of those the automaton holds, by text and term."""
    sizes: list[int] = []
    keys: list[np.ndarray] = []
    held: list[tuple[int, str]] = []
    length = 0

    def scan() -> None:
        nonlocal length
        whole = " " + " ".join(piece for _, piece in held) + " "
        starts = np.cumsum([1, *(len(piece) + 1 for _, piece in held)])
        owner = np.array([number for number, _ in held])
        hits = np.fromiter(chain.from_iterable(automaton.iter(whole)), np.int64).reshape(-1, 2)
        # A match ends with the guard after its term, which may stand before the next text.
        keys.append(owner[np.searchsorted(starts, hits[:, 0] - 1, side="right") - 1] * n_terms + hits[:, 1])
        held.clear()
        length = 0

    for number, text in enumerate(texts):
        guarded = text.translate(_GUARD)
        letters = np.frombuffer(guarded, np.uint8) != 32
        sizes.append(int(np.count_nonzero(letters[1:] & ~letters[:-1])) + int(letters[:1].sum()))
        for piece in _slices(guarded):
            held.append((number, piece.decode("utf-8", "replace")))
            length += len(held[-1][1])
            if length >= SLICE:
                scan()
    if held and n_terms:
        scan()
    key, counts = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    return np.array(sizes, np.int64), key // max(n_terms, 1), key % max(n_terms, 1), counts


def _lists(values: np.ndarray, owners: np.ndarray, rows: int) -> pa.ListArray:
    offsets = np.searchsorted(owners, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def term_counts(docs: DataFrame, part: Terms, id_column: str, text_column: str) -> DataFrame:
    """id, terms with repeats, and the part's terms with their occurrences, of every document."""
    rows = docs.select(F.col(quoted(id_column)).cast("long").alias("id"), F.col(quoted(text_column)).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        automaton = terms.automaton()
        for batch in batches:
            sizes, at, term, counts = count_terms(utf8(batch.column("text")), automaton, len(terms.terms))
            columns = [batch.column("id"), pa.array(sizes), *(_lists(v, at, len(sizes)) for v in (term, counts))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"])

    return staged(rows.mapInArrow(run, COUNTS), "term-counts")


def collection_statistics(counts: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents that hold each term of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms + 2, np.int64)
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            total[0] += np.count_nonzero(sizes)
            total[1] += sizes.sum()
            total[2:] += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_terms + 2)), pa.array(total)], ["at", "x"])

    added = counts.select("n", "terms").mapInArrow(run, "at long, x long").groupBy("at").agg(F.sum("x")).collect()
    found = np.zeros(n_terms + 2, np.int64)
    for at, x in added:
        found[at] = x
    return int(found[0]), int(found[1]), found[2:]


class _Best:
    """The k best documents of each item seen so far: larger scores first, then smaller ids, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows = [np.zeros((4, 0), np.int64)]
        self.count = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        at, item = np.nonzero(scores >= self.least)
        self.rows.append(np.stack([item, scores[at, item], missing[at], ids[at]]))
        self.count += len(at)
        if self.count > 4 * self.k * len(self.least):
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate(self.rows, axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        rows = rows[:, place < self.k]
        last = place[place < self.k] == self.k - 1
        self.least[rows[0, last]] = rows[1, last]
        self.rows, self.count = [rows], 0
        return rows


def score_documents(counts: DataFrame, part: Terms, k: int) -> DataFrame:
    """h1, h2 (an item's text), doc_id, score: of every task the k best documents of each item."""
    n_docs, length, holding = collection_statistics(counts, len(part.terms))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding], np.int64)
    shared = counts.sparkSession.sparkContext.broadcast((part, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weight = shared.value
        n_items = len(terms.keys)
        best = _Best(n_items, k)
        step = max(1, CELLS // max(n_items, 1))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                lists = batch.column("terms")
                at = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                term = lists.flatten().to_numpy().astype(np.int64)
                tf = batch.column("counts").flatten().to_numpy().astype(np.int64)
                n = batch.column("n").to_numpy()
                wide = 50.0 * float(n.max(initial=0)) * n_docs >= 2**63
                m = 100 - 50 + (50 * n.astype(object if wide else np.int64) * n_docs) // max(length, 1)
                part_score = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m.astype(np.int64)[at]))
                # Every (document, term) meets the items that hold the term.
                held = terms.starts[term + 1] - terms.starts[term]
                pair = np.repeat(np.arange(len(term)), held)
                offset = np.arange(len(pair)) - np.repeat(np.cumsum(held) - held, held)
                item = terms.items[terms.starts[term[pair]] + offset]
                scores = np.zeros(batch.num_rows * n_items, np.int64)
                np.add.at(scores, at[pair] * n_items + item, part_score[pair])
                ids = batch.column("id")
                missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                best.add(scores.reshape(-1, n_items), ids.fill_null(0).to_numpy(), missing)
        item, score, missing, ids = best.settle()
        columns = [*terms.keys[item].T, pa.array(ids, mask=missing.astype(bool)), score]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in SCORES.split(", ")])

    return counts.mapInArrow(run, SCORES)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The k documents with the highest score above 0 for each item: item_id, rank, doc_id, score.

    Scores are the integer sums of the contract: weights of rare terms times a saturating term
    frequency that allows for the document's length.  Equal scores rank by ascending id, null ids last; rows with equal
    ids are different documents.  Null and empty texts hold no term; an item without terms, or whose terms no document
    holds, has no rows.  Every row of ``items`` has ranks of its own, with repeated or null ids too; equal texts are searched once.
    Empty tables give no rows.  A part of the items takes PART_BYTES of terms, and the terms of one item at least.
    """
    text = F.coalesce(F.col(quoted(item_text_column)), F.lit(""))
    asked = items.select(
        F.col(quoted(item_column)).alias("item_id"),
        text.alias("text"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
    )
    terms = F.array_distinct(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM_PATTERN), F.lit(0)))
    distinct = asked.select("text", "h1", "h2").distinct().select("h1", "h2", terms.alias("terms"))
    distinct = staged(distinct.filter(F.size("terms") > 0), "item-terms")
    size = F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t)))
    total, rows = distinct.agg(size, F.count(F.lit(1))).first()
    n_parts = max(-(-(total or 0) // PART_BYTES), -(-rows // PART_ITEMS))
    scored = docs.sparkSession.createDataFrame([], SCORES)
    for number in range(n_parts):
        part = Terms.of(distinct.filter(F.pmod("h2", F.lit(n_parts)) == number).orderBy("h1", "h2").collect())
        if part.terms:
            scored = scored.union(score_documents(term_counts(docs, part, id_column, text_column), part, k))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = scored.withColumn("salt", F.spark_partition_id() % SALTS)
    near = Window.partitionBy("h1", "h2", "salt").orderBy(*order)
    kept = salted.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
    whole = Window.partitionBy("h1", "h2").orderBy(*order)
    ranked = kept.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k).drop("salt")
    return asked.drop("text").join(ranked, ["h1", "h2"]).select("item_id", "rank", "doc_id", "score")
