"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees propose rules (the conditions on the way to each of their
nodes), a logistic regression with an L1 penalty picks few of them and weighs
them, and the result is one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.llm import textstats as ts
from rookery.llm.tables import map_batches, quoted, row_of, utf8, with_row

FEATURES = (
    "log_words", "repeated_words", "duplicate_lines", "symbols", "upper", "punctuation", "digits", "exclamations",
    "bars", "word_length", "distinct_words", "equal_neighbours", "longest_run", "symbol_words", "bare_words", "other",
    "lines",
)


@dataclass(frozen=True)
class Settings:
    """Parameters of the fit.  ``max_rows`` bounds the labelled rows that come to the driver (by a hash of their id)."""

    max_rows: int = 20_000
    trees: int = 24
    depth: int = 3
    bins: int = 32
    shrinkage: float = 0.3
    subsample: float = 0.5
    min_leaf: int = 8
    penalty: float = 0.001
    rounds: int = 300
    seed: int = 7


def features(data: bytes) -> list[float]:
    """Statistics of one text in the order of FEATURES; shares, so that long and short texts compare."""
    counts = ts.byte_counts(data)
    lower, upper, digit, _, punctuation, symbol, other = ts.class_counts(counts).tolist()
    words = data.split()
    n = len(words)
    chars = max(lower + upper + digit + punctuation + symbol + other, 1)
    if not n:
        return [0.0] * len(FEATURES)
    ids = ts.word_ids(words)
    repeated = ts.covered_words(ts.repeated_windows(ids), n)
    equal = ids[1:] == ids[:-1]
    changes = np.flatnonzero(np.concatenate([[True], ~equal, [True]]))
    raw = np.frombuffer(data, np.uint8)
    ended = raw[:-1][(ts.BYTE_CLASS[raw[1:]] == 3) & (ts.BYTE_CLASS[raw[:-1]] != 3)] if len(raw) > 1 else raw
    letters = lower + upper + other
    lines = data.count(b"\n") + 1
    return [
        float(np.log1p(n)),
        repeated / n,
        ts.duplicate_lines(data) / lines,
        symbol / chars,
        upper / max(letters, 1),
        punctuation / chars,
        digit / chars,
        float(counts[33]) / n,
        float(counts[124]) / n,
        chars / n,
        len(np.unique(ids)) / n,
        float(equal.sum()) / n,
        float(np.log1p(np.diff(changes).max())),
        float((ts.BYTE_CLASS[ended] == 5).sum()) / n,
        sum(len(w) == 1 and not w.isalnum() and w[0] < 128 for w in words) / n,
        other / chars,
        lines / n,
    ]


def text_features(docs: DataFrame, keep: tuple[str, ...], text_column: str = "text") -> DataFrame:
    """row (the columns of ``keep``) and the statistics of every whole text; null counts as empty."""
    carried = docs.select(row_of(docs, keep), F.col(quoted(text_column)).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        values = np.array([features(d) for d in utf8(batch.column(1))], float).reshape(batch.num_rows, len(FEATURES))
        columns = [batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in values.T)]
        yield pa.RecordBatch.from_arrays(columns, ["row", *FEATURES])

    return map_batches(carried, run, with_row(carried, ", ".join(f"{name} double" for name in FEATURES)))


#: One condition: feature, whether above the threshold, threshold.
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self) -> Column:
        """Probability of label 1 from the columns of FEATURES."""

        def holds(condition: Condition) -> Column:
            name, above, threshold = FEATURES[condition[0]], condition[1], condition[2]
            return F.col(name) > threshold if above else F.col(name) <= threshold

        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            total = total + F.when(reduce(Column.__and__, map(holds, conditions)), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _split(binned, gradient, hessian, rows, bins, min_leaf):
    """Best (feature, bin) to part rows at, by gain; None if no part is large enough."""
    best, found = 1e-9, None
    g, h = gradient[rows], hessian[rows]
    for k in range(binned.shape[1]):
        b = binned[rows, k]
        n = np.cumsum(np.bincount(b, minlength=bins))[:-1]
        gl = np.cumsum(np.bincount(b, g, bins))[:-1]
        hl = np.cumsum(np.bincount(b, h, bins))[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
        gain[(n < min_leaf) | (len(rows) - n < min_leaf)] = -1
        if gain.max() > best:
            best, found = gain.max(), (k, int(gain.argmax()))
    return found


def _grow(binned, edges, gradient, hessian, rows, settings, path, rules, step):
    """Grow one tree, collect the paths to its nodes, add its values to ``step``."""
    cut = _split(binned, gradient, hessian, rows, settings.bins, settings.min_leaf) if len(path) < settings.depth else None
    if cut is None:
        value = -gradient[rows].sum() / (hessian[rows].sum() + 1)
        step.append((path, value))
        return
    feature, place = cut
    above = binned[rows, feature] > place
    for side, part in ((False, rows[~above]), (True, rows[above])):
        longer = (*path, (feature, side, float(edges[feature][place])))
        rules[longer] = None
        _grow(binned, edges, gradient, hessian, part, settings, longer, rules, step)


def _holds(values: np.ndarray, path: tuple[Condition, ...]) -> np.ndarray:
    found = np.ones(len(values), bool)
    for feature, above, threshold in path:
        found &= (values[:, feature] > threshold) == above
    return found


def _tightened(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The same rule with one condition for each feature and side."""
    kept: dict[tuple[int, bool], float] = {}
    for feature, above, threshold in path:
        old = kept.get((feature, above))
        kept[feature, above] = threshold if old is None else max(old, threshold) if above else min(old, threshold)
    return tuple(sorted((f, a, t) for (f, a), t in kept.items()))


def fit_rules(values: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> RuleModel:
    """Rules from boosted trees, weighed by lasso logistic regression; a constant where labels don't differ."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    constant = RuleModel(float(np.log(share / (1 - share))), ())
    if len(np.unique(labels)) < 2:
        return constant
    rng = np.random.default_rng(settings.seed)
    inner = np.linspace(0, 1, settings.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(c, inner, method="lower")) for c in values.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, values.T)], 1)
    edges = [np.append(e, [np.inf] * (settings.bins - len(e))) for e in edges]
    margin = np.full(len(labels), constant.intercept)
    rules: dict[tuple[Condition, ...], None] = {}
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(len(labels)) < settings.subsample)
        leaves: list = []
        _grow(binned, edges, p - labels, p * (1 - p), rows, settings, (), rules, leaves)
        for path, value in leaves:
            margin[_holds(values, path)] += settings.shrinkage * value
    paths = sorted({_tightened(path) for path in rules})
    columns: dict[bytes, tuple] = {}
    for path in paths:
        columns.setdefault(np.packbits(_holds(values, path)).tobytes(), path)
    paths = sorted(columns.values(), key=lambda p: (len(p), p))
    held = np.stack([_holds(values, p) for p in paths], 1).astype(np.float64)
    intercept, weights = _lasso(held, labels, settings)
    return RuleModel(intercept, tuple((p, float(w)) for p, w in zip(paths, weights) if w))


def _lasso(held: np.ndarray, labels: np.ndarray, settings: Settings) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient on centred columns; the intercept is not penalised."""
    centre = held.mean(0)
    x = held - centre
    step = 4 * len(x) / max(np.linalg.norm(x.T @ x, 2), 1e-12)
    weights = ahead = np.zeros(x.shape[1])
    share = labels.mean()
    bias = ahead_bias = float(np.log(share / (1 - share)))
    pace = 1.0
    for _ in range(settings.rounds):
        error = 1 / (1 + np.exp(-(x @ ahead + ahead_bias))) - labels
        moved = ahead - step * (x.T @ error) / len(x)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * settings.penalty, 0)
        new_bias = ahead_bias - 4 * error.mean()
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / faster * (new - weights)
        ahead_bias = new_bias + (pace - 1) / faster * (new_bias - bias)
        weights, bias, pace = new, new_bias, faster
    return float(bias - centre @ weights), weights


def train_quality(
    stats: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_field: str = "row.doc_id"
) -> RuleModel:
    """Fit on labelled rows: ``stats`` of :func:`text_features`, ``labels`` with doc_id and quality.

    At most ``max_rows`` rows are used, those with the smallest hash of their
    id, so the same rows at every run.  Null ids and labels are left out.

    A bound on the hash, from the number of labels, leaves about twice ``max_rows`` labels before the
    statistics are joined, so that what is ordered and sent does not grow with the corpus.  Should the
    documents hold too few of those, the bound is widened.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("_label_id"), F.col("quality").cast("double").alias("_label")
    )
    place = F.xxhash64("_label_id")
    share = min(1.0, 2 * settings.max_rows / max(known.count(), 1))
    while True:
        near = known if share >= 1 else known.filter(place <= int(share * 2**64) - 2**63)
        joined = stats.join(near, F.col(id_field) == F.col("_label_id"))
        sample = joined.orderBy(place, *FEATURES, "_label").limit(settings.max_rows)
        rows = sample.select("_label", *FEATURES).collect()
        if share >= 1 or len(rows) >= settings.max_rows:
            break
        share = min(1.0, 4 * share)
    found = np.array([tuple(r) for r in rows], float).reshape(-1, len(FEATURES) + 1)
    return fit_rules(found[:, 1:], found[:, 0], settings)


def score_quality(stats: DataFrame, model: RuleModel) -> DataFrame:
    """row and score (0 to 1, higher: label 1 likelier) from the statistics."""
    return stats.select("row", model.score().alias("score"))
