from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from rookery.llm import quality_rules as qr


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:i])
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def prose(seed, n):
    rng = np.random.default_rng(seed)
    common = ["the", "of", "and", "to", "in", "that", "was"]
    rare = ["".join(rng.choice(list("abcdefghilmnoprst"), 6)) for _ in range(300)]
    return " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)) + "."


def test_counts_and_verdicts(spark, make_docs):
    junk = {
        100: " ".join(w + "###" for w in prose(1, 300).split()),
        101: prose(2, 300).upper(),
        102: "\n".join([prose(3, 20)] * 30),
        103: " ".join(prose(4, 60).split()[:49]),
        104: None,
        105: "",
        106: " \n\t ",
        107: "word " * 70000,
    }
    rows = [(i, prose(i + 10, 120 + 15 * i), "en" if i % 3 else None, "s") for i in range(40)]
    rows += [(i, text, "en", "s") for i, text in junk.items()]
    rows += [rows[0], (None, prose(99, 200) + "\nsame x\nsame x\n\n \nÉà\x1c| é", "en", "s")]
    docs = make_docs(rows).selectExpr("*", "1 as n_words", "2 as kept", "3 as row")
    found = qr.quality_rules(docs).collect()
    assert sorted((str(r.row.doc_id), r.row.text or "") for r in found) == sorted((str(r[0]), r[1] or "") for r in rows)
    for r in found:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == plain_counts(r.row.text)
        assert r.kept == (r.row.doc_id not in junk), (r.row.doc_id, r.char_divergence, r.word_divergence)


def test_no_rows_and_no_languages(spark, make_docs):
    docs = make_docs([(1, prose(1, 100), None, "s"), (2, "x", None, "s")])
    assert qr.quality_rules(docs.filter("false")).collect() == []
    assert {r.row.doc_id: (r.kept, r.nearest_lang) for r in qr.quality_rules(docs).collect()} == {
        1: (True, None),
        2: (False, None),
    }


def test_common_words_are_a_superset(spark, make_docs):
    rows = [(i, prose(i, 200), "en" if i < 15 else "xx", "s") for i in range(30)]
    found = {(r.lang, bytes(r.word)) for r in qr.common_words(make_docs(rows), 0.01).collect()}
    counts = {"en": Counter(), "xx": Counter()}
    for _, text, lang, _ in rows:
        counts[lang].update(re.findall("[a-z]+", text.lower()))
    for lang, words in counts.items():
        want = {(lang, w.encode()) for w, n in words.items() if n >= 0.01 * words.total()}
        assert want <= found
        assert len([f for f in found if f[0] == lang]) <= 200


def test_divergence_bounds():
    p, q = np.array([[1.0, 0.0], [0.5, 0.5]]), np.array([0.0, 1.0])
    got = qr.divergence(p, q)
    assert got[0] == 1.0 and 0 < got[1] < 1 and qr.divergence(q[None], q)[0] == 0


def listing(seed, n=400):
    """An atypical text that passes the base rules."""
    rng = np.random.default_rng(seed)
    return " ".join(f"{rng.integers(100, 99999)}:{rng.integers(10, 99)};" for _ in range(n))


def edited(text, seed, share=0.03):
    rng = np.random.default_rng(seed)
    words = text.split()
    for place in rng.choice(len(words), int(share * len(words)), replace=False):
        words[place] = f"{rng.integers(100, 99999)}:{rng.integers(10, 99)};"
    return " ".join(words)


@pytest.mark.parametrize("near", [False, True])
def test_a_third_of_all_rows_as_copies_moves_no_verdict(spark, make_docs, near):
    clean = [(i, prose(i + 10, 120 + 15 * i), "en", "s") for i in range(60)]
    base = listing(1)
    copies = [(1000 + i, edited(base, i) if near else base, "en", "s") for i in range(30)]
    alone = {r.row.doc_id: r.kept for r in qr.quality_rules(make_docs(clean)).collect()}
    found = {r.row.doc_id: r.kept for r in qr.quality_rules(make_docs(clean + copies)).collect()}
    assert all(alone.values()) and {k: v for k, v in found.items() if k < 1000} == alone
    assert not any(v for k, v in found.items() if k >= 1000)


def test_copies_do_not_hide_common_words(spark, make_docs):
    rules = qr.Rules()
    clean = [(i, prose(i, 200), "en", "s") for i in range(30)]
    # Copies with three times as many words as all else.
    copies = [(1000 + i, prose(999, 1800), "en", "s") for i in range(10)]
    words = sorted(bytes(r.word) for r in qr.common_words(make_docs(clean + copies), rules.common_share / 4).collect())
    stats = qr.text_statistics(make_docs(clean + copies), words, rules, ("doc_id", "lang"))
    (ref,) = qr.references(stats, len(words), rules)
    assert {b"the", b"of", b"and", b"to", b"in", b"that", b"was"} <= {words[i] for i in ref.word_ids}
