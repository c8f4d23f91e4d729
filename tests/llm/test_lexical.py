from __future__ import annotations

import math
import random
import re

import pytest

from rookery.llm import lexical

UPPER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return re.findall(lexical.TERM_PATTERN, (text or "").translate(UPPER))


def plain(docs, items, k):
    """(doc_id, text) and (item_id, text) rows -> sorted (item_id, rank, doc_id, score)."""
    held = [(i, terms_of(t)) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    out = []
    for item_id, text in items:
        scored = []
        for i, terms in held:
            if not terms:
                continue
            m, total = 100 - 50 + (50 * len(terms) * n_docs) // length, 0
            for term in set(terms_of(text)):
                tf = terms.count(term)
                if tf:
                    df = sum(term in t for _, t in held)
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    total += w * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if total > 0:
                scored.append((-total, i is None, i or 0, i))
        out += [(item_id, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


def run(spark, docs, items, k=50):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = docs.selectExpr("*", "1 as score", "2 as id", "3 as `a b`", "4 as `a.b`", "5 as n").repartition(3)
    items = items.selectExpr("*", "1 as rank", "2 as h1", "3 as doc_id", "4 as `a.b`")
    return ordered(map(tuple, lexical.rank_documents(docs, items, k).collect()))


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    words = ["a", "b", "ab", "Ab", "the", "The", "ñu", "Ñu", "日本", "x1", "1x", "é", "zz", "q\u00a0r", "\U0001f600", "İ"]
    gaps = [" ", "  ", "-", "\n", "\t,", "_", ".", "\x00", "\x7f", "'"]

    def text(size):
        return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(size))

    docs = [(i, rng.choice(gaps) * rng.randrange(2) + text(rng.choice([0, 1, 3, 8, 40]))) for i in range(n)]
    items = [(i, text(rng.choice([1, 2, 6, 20]))) for i in range(15)]
    return docs, items


@pytest.mark.parametrize(("size", "part", "rows"), [(1 << 20, 1 << 20, 5000), (7, 20, 2), (60, 1 << 20, 4)])
def test_equals_brute_force(spark, monkeypatch, size, part, rows):
    monkeypatch.setattr(lexical, "SLICE", size)
    monkeypatch.setattr(lexical, "PART_BYTES", part)
    monkeypatch.setattr(lexical, "PART_ITEMS", rows)
    monkeypatch.setattr(lexical, "CELLS", 40)
    docs, items = corpus()
    # A third of all documents are copies; ids repeat and are null.
    docs += [(1000 + i, docs[3][1] + " the ab") for i in range(70)] + [(None, "zz ab the"), (None, None), (5, "ab zz"), (5, "ab zz")]
    items += [(3, items[4][1]), (None, "the zz"), (77, None), (78, ""), (79, "--"), (80, "unheard"), (81, items[4][1])]
    for k in (3, 50):
        assert run(spark, docs, items, k) == plain(docs, items, k)


def test_empty_tables(spark):
    docs, items = corpus(2, 10)
    assert run(spark, [], items) == [] == run(spark, docs, [])
    assert run(spark, [(1, None), (2, ""), (3, "- -")], items) == []
    assert run(spark, [(1, "one")], [(1, "one")]) == plain([(1, "one")], [(1, "one")], 50)


def test_long_text(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 1000)
    docs = [(1, "ab " * 200_000 + "y" * 5000 + " zz"), (2, "zz"), (3, "ab" * 100_000)]
    items = [(1, "ab zz"), (2, "y" * 5000)]
    assert run(spark, docs, items) == plain(docs, items, 50)


def test_counts_of_terms():
    terms = lexical.Terms.of([(1, 2, ["a", "b"]), (3, 4, ["b"])])
    assert terms.items[terms.starts[1] : terms.starts[2]].tolist() == [0, 1]
    sizes, text, term, counts = lexical.count_terms([b"a B a", b"", b"ab b"], terms.automaton(), 2)
    assert sizes.tolist() == [3, 0, 2]
    assert list(zip(text.tolist(), term.tolist(), counts.tolist())) == [(0, 0, 2), (0, 1, 1), (2, 1, 1)]
