from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from rookery.llm import suffix_dedup as sd
from rookery.llm.suffix_array import suffix_array


def plain(rows):
    """(doc_id, text) rows -> (n_bytes, n_removed, n_spans, sha256) of each."""
    first = {}
    datas = [(i, (t or "").encode()) for i, t in rows]
    for i, data in datas:
        if i is None:
            continue
        for k in range(len(data) - sd.LENGTH + 1):
            s = data[k : k + sd.LENGTH]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, data in datas:
        gone = [False] * len(data)
        if i is not None:
            for k in range(len(data) - sd.LENGTH + 1):
                if first[data[k : k + sd.LENGTH]] < i:
                    gone[k : k + sd.LENGTH] = [True] * sd.LENGTH
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n, vocabulary=4000):
    return " ".join(f"{rng.randrange(vocabulary):x}é" if rng.random() < 0.1 else f"{rng.randrange(vocabulary):x}" for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [words(rng, n) for n in (12, 30, 60)]
    rows = []
    for i in range(60):
        text = words(rng, rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 3)):
            cut = rng.randrange(0, len(text) + 1)
            text = text[:cut] + rng.choice(passages) + text[cut:]
        rows.append((rng.randrange(0, 10**12) if i % 2 else i, text))
    rows += [(i + 500, rows[i][1]) for i in range(10)]
    rows += [(i + 700, rows[i][1].replace("a", "b", 2)) for i in range(20)]
    rows += [(3, "ab" * 300), (4, "ab" * 200 + "c" + "ab" * 90), (5, "x" * 49), (6, "x" * 50), (8, "x" * 130)]
    rows += [(9, None), (10, ""), (None, rows[0][1]), (None, None), (3, words(rng, 60)), (3, rows[0][1] + "!")]
    rows += [(-5, passages[2]), (0, rows[0][1]), (0, rows[0][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, range_bytes, task_pieces", [(1, 10**9, 10**6), (2, 3000, 40), (3, 10**9, 5)])
def test_equals_brute_force(spark, make_docs, seed, range_bytes, task_pieces):
    rows = corpus(seed)
    docs = make_docs([(i, t, "en", "s") for i, t in rows]).selectExpr("*", "1 as doc", "2 as marks", "3 as kept")
    found = sd.remove_repeats(docs, range_bytes=range_bytes, task_pieces=task_pieces, with_text=True).collect()
    got = sorted((str(r.row.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == sorted((str(i), *p) for (i, _), p in zip(rows, plain(rows)))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def frequent(seed):
    """A passage a third of all texts hold, in ever other contexts, and a text that repeats it."""
    rng = random.Random(seed)
    passage = words(rng, 25)
    rows = [(i, words(rng, 20) + passage + words(rng, 20) if i % 3 == 0 else words(rng, 30)) for i in range(1, 91)]
    return [*rows, (200, passage * 40), (0, words(rng, 5) + passage[:70])]


def test_frequent_anchors_are_not_gathered(spark, make_docs):
    rows = frequent(11)
    docs = make_docs([(i, t, "en", "s") for i, t in rows])
    texts = docs.selectExpr("doc_id as doc", "0 as ord", "text")
    blobs = sd._anchor_blobs(texts, 40)
    counted = sd._anchor_blobs(texts, 40, packed=False)
    assert sorted(sd._big_ranges(blobs, 60).collect()) == sorted(sd._big_ranges(counted, 60).collect()) != []
    assert sd._big_ranges(blobs, 10**6).count() == 0
    kinds = sd._spread_entries(blobs).columns
    assert sorted(map(tuple, sd._spread_entries(blobs).drop("ord", "start", "n", "offset").distinct().collect())) == sorted(
        map(tuple, sd._shared_entries(blobs).select(kinds).drop("ord", "start", "n", "offset").distinct().collect())
    )
    for limit in (0, 60):
        found = sd.remove_repeats(docs, range_bytes=300, range_entries=limit).collect()
        got = sorted((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
        assert got == sorted((i, *p) for (i, _), p in zip(rows, plain(rows)))


def test_long_text_crosses_blocks(spark, make_docs):
    rng = random.Random(7)
    long = words(rng, 60000, 10**6)
    assert len(long.encode()) > 4 * sd.BLOCK
    shifted = "zz" + long[1000:]
    rows = [(1, long), (2, shifted), (3, words(rng, 10, 10**6) + long[sd.BLOCK - 100 : sd.BLOCK + 150])]
    found = sd.remove_repeats(make_docs([(i, t, "en", "s") for i, t in rows])).collect()
    got = sorted((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == sorted((i, *p) for (i, _), p in zip(rows, plain(rows)))


def test_empty_table(spark, make_docs):
    docs = make_docs([(1, "x", "en", "s")])
    assert sd.remove_repeats(docs.filter("false")).collect() == []
    assert [r.n_removed for r in sd.remove_repeats(docs).collect()] == [0]


def test_suffix_array_equals_sorting():
    rng = random.Random(3)
    for _ in range(400):
        base = [rng.randint(1, rng.choice([1, 2, 4, 20])) for _ in range(rng.randint(0, 30))]
        text = base * rng.randint(1, 3) + [0]
        assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_windows_and_packing():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 40, 300).astype(np.uint64)
    (least,) = sd._doubled(values, (27,), lambda a, b, _: np.minimum(a, b))
    assert least.tolist() == [values[i : i + 27].min() for i in range(len(values) - 26)]
    columns = {name: rng.integers(0, 1 << min(8 * width, 62), 50) for name, width in sd._FIELDS}
    columns["doc"][:2] = [-7, 1 << 62]
    back = sd._unpack(sd._pack(columns))
    assert all((back[k] == columns[k]).all() for k in columns)
