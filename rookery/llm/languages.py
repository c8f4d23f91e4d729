"""Language identification as a mixture of languages.

A text is read as drawn from several languages at once.  Expectation-maximisation
finds how much each contributes from the likelihood of its n-grams, for
nested sets of languages; the set with the best penalised likelihood is chosen.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.tables import map_batches, quoted, row_of, utf8, with_row

#: N-grams of one to three bytes of the lowered text fall into so many bins; the model is languages x bins.
BINS = 1 << 12
UNKNOWN = "und"


@dataclass(frozen=True)
class Mixture:
    """Parameters of the inference."""

    rounds: int = 12
    #: A further language must raise the log likelihood by this much times the logarithm of the n-grams.
    penalty: float = 6.0
    #: Added to every bin of a language.
    smoothing: float = 0.5


#: Every white space or ASCII character that is no letter as one separator; letters lowered where that keeps their length.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def bin_counts(data: bytes) -> np.ndarray:
    """Bins of a text's n-grams that touch a letter; zeros where it has no letter."""
    folded = _FOLD[np.frombuffer(data, np.uint8)]
    if not len(folded):
        return np.zeros(BINS, np.int64)
    # One separator between words, one at each end.
    folded = np.concatenate([[32], folded, [32]]).astype(np.uint32)
    blank = folded == 32
    folded = folded[~(blank & np.append(False, blank[:-1]))]
    letters = folded != 32
    found = np.zeros(BINS, np.int64)
    code = np.zeros(len(folded), np.uint32)
    touched = np.zeros(len(folded), bool)
    for n in (1, 2, 3):
        size = len(folded) - n + 1
        if size <= 0:
            break
        code = code[:size] * np.uint32(257) + folded[n - 1 :] + np.uint32(1)
        touched = touched[:size] | letters[n - 1 :]
        mixed = (code * np.uint32(2654435761)) >> np.uint32(32 - 12)
        found += np.bincount(mixed[touched], minlength=BINS)
    return found


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: languages x BINS, each row sums to 1.
    shares: np.ndarray


def train_languages(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", smoothing: float = Mixture.smoothing
) -> LanguageModel:
    """N-gram shares of each language, from all documents that name one.

    Tasks add up their documents, so languages x BINS numbers leave each task and reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if lang not in sums:
                    sums[lang] = np.zeros(BINS, np.int64)
                sums[lang] += bin_counts(data)
        for lang, counts in sums.items():
            bins = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(bins), pa.string()), pa.array(bins), pa.array(counts[bins])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bin", "n"])

    lang, text = F.col(quoted(lang_column)), F.col(quoted(text_column))
    tagged = docs.filter(lang.isNotNull()).select(lang.alias("lang"), text.alias("text"))
    rows = tagged.mapInArrow(run, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n")).collect()
    languages = tuple(sorted({r[0] for r in rows}))
    shares = np.full((len(languages), BINS), smoothing)
    for lang, place, n in rows:
        shares[languages.index(lang), place] += n
    return LanguageModel(languages, shares / shares.sum(1, keepdims=True))


def _fitted(counts: np.ndarray, allowed: np.ndarray, model: LanguageModel, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages by expectation-maximisation, and the log likelihood."""
    weights = allowed / allowed.sum(1, keepdims=True)
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    for _ in range(rounds):
        weights = weights * ((counts / (weights @ model.shares)) @ model.shares.T) / total
        weights /= np.maximum(weights.sum(1, keepdims=True), 1e-300)
    return weights, (counts * np.log(weights @ model.shares)).sum(1)


def mixture_shares(counts: np.ndarray, model: LanguageModel, settings: Mixture) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen languages for each row of counts, and the size of the chosen set.

    Sets are nested: the best single language, then the languages in the order
    of their proportions if all are allowed, up to all of them.  The set of the best penalised likelihood is
    chosen, the smaller one at equality.  No set is likelier than all languages together, so a size is fitted only
    to the texts for which that bound pays.
    """
    n_langs = len(model.languages)
    fee = settings.penalty * np.log(counts.sum(1) + 1)
    single = counts @ np.log(model.shares).T
    best = np.eye(n_langs)[single.argmax(1)]
    score, size = single.max(1), np.ones(len(counts), np.int64)
    full, likelihood = _fitted(counts, np.ones((len(counts), n_langs)), model, settings.rounds)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    for k in range(2, n_langs + 1):
        rows = np.flatnonzero(likelihood - (k - 1) * fee > score)
        if not len(rows):
            continue
        weights, reached = _fitted(counts[rows], (rank[rows] < k).astype(float), model, settings.rounds)
        paid = reached - (k - 1) * fee[rows]
        better = paid > score[rows]
        weights, rows = weights[better], rows[better]
        best[rows], score[rows], size[rows] = weights, paid[better], k
    return best, size


def identify_languages(
    docs: DataFrame,
    model: LanguageModel,
    keep: tuple[str, ...] | None = None,
    settings: Mixture = Mixture(),
    text_column: str = "text",
) -> DataFrame:
    """Language of every document: row (the columns of ``keep``, or all), lang_pred, score, mixture.

    ``mixture`` holds the chosen languages with their proportions, largest
    first; lang_pred is its first, score its proportion.  Null texts, texts
    without a letter, and all texts if no language was learned get ``und`` and
    0.  Ties go to the language first by name.  Texts are counted whole.
    """
    carried = docs.select(row_of(docs, keep or docs.columns), F.col(quoted(text_column)).alias("text"))
    pair = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def run(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            texts = list(utf8(part.column(1)))
            known = [bool(model.languages) and has_letter(data.decode()) for data in texts]
            at = np.flatnonzero(known)
            found: list[list[dict]] = [[] for _ in texts]
            if len(at):
                counts = np.stack([bin_counts(texts[i]) for i in at]).astype(float)
                shares, _ = mixture_shares(counts, model, settings)
                for i, row in zip(at, shares):
                    order = [k for k in np.argsort(-row, kind="stable") if row[k] > 0]
                    found[i] = [{"lang": model.languages[k], "share": min(float(row[k]), 1.0)} for k in order]
            columns = [
                part.column(0),
                pa.array([m[0]["lang"] if m else UNKNOWN for m in found], pa.string()),
                pa.array([m[0]["share"] if m else 0.0 for m in found], pa.float64()),
                pa.array(found, pa.list_(pair)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "score", "mixture"])

    more = "lang_pred string, score double, mixture array<struct<lang: string, share: double>>"
    return map_batches(carried, run, with_row(carried, more))
