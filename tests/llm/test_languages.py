from __future__ import annotations

import math
import random

import numpy as np
import pytest

from rookery.llm import languages as lg

WORDS = {
    "en": "the of and that with from this have which their about would these other".split(),
    "de": "der die und nicht mit auch ein sich werden über können müssen für schön".split(),
    "fr": "le les des une pour dans avec est été même très être où façon français".split(),
}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(i, text(rng, lang, rng.randrange(5, 120)), lang, "s") for i, lang in enumerate(list(WORDS) * 30)]


@pytest.fixture(scope="module")
def model(spark, rows):
    schema = "doc_id long, text string, lang string, source string"
    return lg.train_languages(spark.createDataFrame([*rows, (999, None, "en", "s"), (998, "x", None, "s")], schema))


def test_shares_equal_plain_counts(rows, model):
    assert model.languages == ("de", "en", "fr")
    for k, lang in enumerate(model.languages):
        counts = sum(lg.bin_counts(r[1].encode()) for r in rows if r[2] == lang) + 0.5
        assert np.allclose(model.shares[k], counts / counts.sum())


def test_bins_ignore_case_and_separators():
    a, b = lg.bin_counts(b"The  cat!! sat"), lg.bin_counts(b" the cat\n1 SAT ")
    assert (a == b).all() and a.sum() == 9 + 12 + 11
    assert lg.bin_counts(b"").sum() == lg.bin_counts(b" 12 .").sum() == 0


def test_held_out_accuracy_and_mixtures(spark, make_docs, model):
    rng = random.Random(9)
    new = [(i, text(rng, lang, rng.randrange(8, 150)), lang, "s") for i, lang in enumerate(list(WORDS) * 20)]
    both = text(rng, "en", 200) + " " + text(rng, "fr", 100)
    odd = [(100, None), (101, ""), (102, "12 .,!"), (103, both), (104, "the " * 100000), (None, "der die und"), (100, None)]
    docs = make_docs(new + [(i, t, None, None) for i, t in odd]).selectExpr("*", "1 as score", "2 as mixture", "3 as row")
    found = lg.identify_languages(docs, model).collect()
    assert len(found) == len(new) + len(odd)
    right = [r.lang_pred == r.row.lang for r in found if r.row.lang]
    assert sum(right) >= 0.97 * len(right)
    by_id = {r.row.doc_id: r for r in found}
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].mixture) == ("und", 0.0, []) for i in (100, 101, 102))
    assert [m.lang for m in by_id[103].mixture] == ["en", "fr"] and 0.55 < by_id[103].score < 0.8
    assert by_id[104].lang_pred == "en" and by_id[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in found)


def test_expectation_maximisation_raises_the_likelihood(model):
    rng = random.Random(3)
    counts = np.stack([lg.bin_counts((text(rng, "en", 50) + " " + text(rng, "de", 50)).encode())]).astype(float)
    allowed = np.ones((1, 3))
    scores = [lg._fitted(counts, allowed, model, n)[1][0] for n in range(8)]
    assert all(b >= a - 1e-9 for a, b in zip(scores, scores[1:]))


def test_nothing_learned(spark, make_docs):
    docs = make_docs([(1, "abc", None, "s")])
    empty = lg.train_languages(docs)
    assert empty.languages == ()
    assert [r.lang_pred for r in lg.identify_languages(docs, empty).collect()] == ["und"]
    assert lg.identify_languages(docs.filter("false"), empty).collect() == []


def brute_mixture(counts, model, settings):
    """Best penalised likelihood over all nested sets, one text at a time."""
    n_langs = len(model.languages)
    fee = settings.penalty * math.log(counts.sum() + 1)

    def fitted(allowed):
        weights = np.array([1.0 / len(allowed) if k in allowed else 0.0 for k in range(n_langs)])
        for _ in range(settings.rounds):
            shares = [[weights[k] * model.shares[k, b] for k in range(n_langs)] for b in np.flatnonzero(counts)]
            held = [counts[b] for b in np.flatnonzero(counts)]
            weights = np.array([sum(n * s[k] / sum(s) for n, s in zip(held, shares)) for k in range(n_langs)])
            weights /= weights.sum()
        likelihood = sum(counts[b] * math.log((weights * model.shares[:, b]).sum()) for b in np.flatnonzero(counts))
        return weights, likelihood

    single = [(counts * np.log(model.shares[k])).sum() for k in range(n_langs)]
    best = np.eye(n_langs)[int(np.argmax(single))]
    score = max(single)
    full, bound = fitted(range(n_langs))
    order = np.argsort(-full, kind="stable")
    for k in range(2, n_langs + 1):
        weights, likelihood = fitted(set(order[:k].tolist()))
        if bound - (k - 1) * fee > score and likelihood - (k - 1) * fee > score:
            best, score = weights, likelihood - (k - 1) * fee
    return best


@pytest.fixture(scope="module")
def six(spark):
    """A model of six languages with words of their own."""
    rng = random.Random(5)
    words = {f"l{k}": ["".join(rng.choice(part) for _ in range(6)) for _ in range(40)] for k, part in enumerate(PARTS)}
    schema = "doc_id long, text string, lang string, source string"
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(60)), lang, "s") for i, lang in enumerate(list(words) * 8)]
    return words, lg.train_languages(spark.createDataFrame(rows, schema))


PARTS = ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "zäöüß"]


def test_mixtures_equal_brute_force(six):
    words, model = six
    rng = random.Random(8)
    settings = lg.Mixture()
    for langs in (1, 2, 3, 5, 6):
        mixed = " ".join(rng.choice(words[lang]) for lang in list(words)[:langs] for _ in range(rng.randrange(60, 160)))
        counts = lg.bin_counts(mixed.encode()).astype(float)
        got, size = lg.mixture_shares(counts[None], model, settings)
        assert size[0] == langs == np.count_nonzero(got[0])
        assert np.allclose(got[0], brute_mixture(counts, model, settings), atol=1e-6)
    for _ in range(6):
        mixed = " ".join(rng.choice(words[rng.choice(list(words))]) for _ in range(rng.randrange(3, 40)))
        counts = lg.bin_counts(mixed.encode()).astype(float)
        got, _ = lg.mixture_shares(counts[None], model, settings)
        assert np.allclose(got[0], brute_mixture(counts, model, settings), atol=1e-6)


def test_five_languages_are_reported(spark, make_docs, six):
    words, model = six
    rng = random.Random(4)
    mixed = " ".join(rng.choice(words[lang]) for lang in list(words)[:5] for _ in range(100))
    (row,) = lg.identify_languages(make_docs([(1, mixed, None, "s")]), model).collect()
    assert sorted(m.lang for m in row.mixture) == ["l0", "l1", "l2", "l3", "l4"]
