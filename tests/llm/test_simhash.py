from __future__ import annotations

import random
import re

import pytest
import xxhash

from rookery.llm import simhash
from rookery.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """prints: {id: fingerprint} -> {id: smallest id reachable}."""
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in prints}


def test_fingerprint_equals_plain_version():
    texts = ["", " \n", "One", "one TWO", "É a b\x1cc d", "a b c " * 40000, "x y z w", None]
    for text in texts:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("paired_bucket", [1, 2, 32])
def test_links_equal_brute_force(spark, paired_bucket):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for base in list(prints)[:8]:
        for _ in range(25):
            near = base
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                near ^= 1 << bit
            prints.add(near)
    prints |= {0, (1 << 64) - 1, 1, 1 << 63}
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    links = [(r.a, r.b) for r in simhash.fingerprint_links(frame, paired_bucket).collect()]
    assert all((signed[a] ^ signed[b]).bit_count() <= 2 for a, b in links)
    want = plain_components(signed)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {s: got.get(s, s) for s in signed} == want


def test_documents_with_gaps_copies_and_clashing_names(spark, make_docs):
    base = [f"w{i}" for i in range(400)]
    near = [*base[:200], "other", *base[201:]]
    rows = [
        (7, " ".join(base), "en", "s"),
        (3, " ".join(near), "en", "s"),
        (9, " ".join(base), "en", "s"),
        (9, " ".join(base), "en", "s"),
        (11, None, None, None),
        (2, "", "en", "s"),
        (None, " ".join(base).upper(), "en", "s"),
        (None, "alone here", "en", "s"),
        (20, "quite another text", "en", "s"),
    ]
    docs = make_docs(rows).selectExpr("*", "1 as fingerprint", "'x' as component_id", "2 as uid", "3 as row")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    prints = {i: plain_fingerprint(r[1]) for i, r in enumerate(rows)}
    comp = plain_components(prints)
    least = {}
    for i, c in comp.items():
        ids = [rows[j][0] for j in comp if comp[j] == c and rows[j][0] is not None]
        least[i] = min(ids) if ids else None
    want = sorted((str(rows[i][0]), rows[i][1] or "", str(least[i])) for i in least)
    assert sorted((str(r.row.doc_id), r.row.text or "", str(r.component_id)) for r in found) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    firsts = {}
    for i, c in comp.items():
        firsts.setdefault(c, []).append((rows[i][0] is None, rows[i][0] or 0))
    want = sorted(str(None if none else i) for none, i in map(min, firsts.values()))
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert simhash.one_of_each(docs.filter("false")).collect() == []
    assert simhash.near_duplicates(docs.filter("false")).collect() == []


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(5, i) for i in range(1000, 1100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(1000, 1100)]}
