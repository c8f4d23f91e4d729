"""The pipeline against a brute-force version of each of its stages, on all documents of the smallest tables."""

from __future__ import annotations

import hashlib
import math
import re
import statistics
import zlib
from collections import Counter

import pytest
from test_quality_rules import plain_counts
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from rookery.llm import quality_rules, suffix_dedup
from rookery.llm.tables import staged, table

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def jensen_shannon(p, q):
    def entropy(x):
        return -sum(v * math.log2(v) for v in x if v > 0)

    return entropy([(a + b) / 2 for a, b in zip(p, q)]) - (entropy(p) + entropy(q)) / 2


def character_classes(text):
    kinds = [r"[a-z]", r"[A-Z]", r"[0-9]", r"[\x20\x09-\x0D]", r"[.,;:'\"!?()-]", r"[^\x00-\x7F]"]
    found = [len(re.findall(k, text)) for k in kinds]
    return [*found, len(text) - sum(found)]


def plain_references(rows, rules):
    """lang -> (common words, their shares and that of all others, shares of the character classes)."""
    words = {r[0]: re.findall(r"[a-z\u0080-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1])) for r in rows}
    failed = {r[0]: plain_counts(r[1])[5] for r in rows}
    # Rare words are those that are no candidate for a common word of any language.
    candidates = {bytes(w) for w in plain_rules.candidates}
    refs = []
    for lang in sorted({r[2] for r in rows}):
        blocks = {}
        for r in rows:
            if r[2] == lang and not failed[r[0]]:
                rare = set(r[1].encode().split()) - candidates or {r[1].encode()}
                blocks.setdefault(min(map(zlib.crc32, rare)) % rules.blocks, []).append(r)
        counts = [sum((Counter(words[r[0]]) for r in held), Counter()) for held in blocks.values()]
        counts_held = [c for c in counts if c.total()]
        middle = {
            w: statistics.median(c[w] / c.total() for c in counts_held)
            for w in set().union(*counts_held)
            if w.encode() in candidates
        }
        common = sorted(w for w, share in middle.items() if share >= rules.common_share)
        sums = [[sum(c) for c in zip(*(character_classes(r[1]) for r in held))] for held in blocks.values()]
        classes = [statistics.median(s[i] / sum(s) for s in sums) for i in range(7)]
        shares = [middle[w] for w in common]
        refs.append((common, [*shares, max(1 - sum(shares), 0)], [c / sum(classes) for c in classes]))
    return words, failed, refs


def plain_rules(rows):
    rules = quality_rules.Rules()
    words, failed, refs = plain_references(rows, rules)
    kept = []
    for row in rows:
        tokens, chars, n_words = words[row[0]], character_classes(row[1]), plain_counts(row[1])[0]
        own = Counter(tokens)
        best = None
        for common, shares, classes in refs:
            p = [own[w] / max(len(tokens), 1) for w in common]
            by_word = jensen_shannon([*p, 1 - sum(p)], shares)
            if best is None or by_word < best[0]:
                best = by_word, jensen_shannon([c / max(sum(chars), 1) for c in chars], classes)
        by_word, by_char = best
        odd = sum(chars) >= rules.min_chars_judged and by_char > rules.max_char_divergence + rules.char_allowance / max(
            n_words, 1
        )
        odd |= len(tokens) >= rules.min_words_judged and by_word > rules.max_word_divergence + rules.word_allowance / max(
            len(tokens), 1
        )
        if not failed[row[0]] and not odd:
            kept.append(row)
    return kept


def plain_near_duplicates(rows):
    groups = plain_components({r[0]: plain_fingerprint(r[1]) for r in rows})
    return [r for r in rows if groups[r[0]] == r[0]]


def plain_cut(rows):
    size = suffix_dedup.LENGTH
    first = {}
    for i, text, *_ in sorted(rows):
        data = text.encode()
        for k in range(len(data) - size + 1):
            first.setdefault(data[k : k + size], i)
    out = []
    for i, text, lang, source, _ in rows:
        data = text.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            if first[data[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        text = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
        out.append((i, text, lang, source, len(text)))
    return out


def plain_mix(rows):
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in rows}
    sources = sorted({r[3] for r in rows})
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    held = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in sources}
    target = dict.fromkeys(sources, 0.0)
    open_sources, left = set(sources), float(sum(held.values()))
    while open_sources:
        share = left / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if share * weight[s] > 3 * held[s]}
        if not full:
            target.update({s: share * weight[s] for s in open_sources})
            break
        target.update({s: 3.0 * held[s] for s in full})
        left -= sum(3.0 * held[s] for s in full)
        open_sources -= full
    def unit(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32

    out = []
    for place, s in enumerate(sources):
        own = sorted(
            (r for r in rows if r[3] == s),
            key=lambda r: (
                size[r[0]] >> max(size[r[0]].bit_length() - 8, 0) << max(size[r[0]].bit_length() - 8, 0),
                hashlib.md5(f"mix{r[0]}".encode()).hexdigest(),
            ),
        )
        step, u = (target[s] / held[s] if held[s] else 0.0), unit(f"mix{place}")
        for n, r in enumerate(own):
            out += [r] * (math.floor((n + 1) * step + u) - math.floor(n * step + u))
    return out, target, held


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first and after each stage."""
    docs = table(spark, SF_DIR, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), name)
        found.append(docs)
    return found


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_stages_are_those_asked_for(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_duplicates", "suffix_dedup", "mix_sources", "sentencepiece",
    ]
    assert all(s.columns == COLUMNS for s in stages[:-1])


@pytest.mark.parametrize("k, plain", [(0, plain_rules), (1, plain_near_duplicates), (2, plain_cut)])
def test_stage_equals_brute_force(stages, k, plain):
    before = rows_of(stages[k])
    if k == 0:
        share = quality_rules.Rules().common_share / (1 + quality_rules.DILUTION)
        plain_rules.candidates = [r.word for r in quality_rules.common_words(stages[0], share).collect()]
    after = sorted(plain(before))
    assert rows_of(stages[k + 1]) == after
    assert k == 2 or len(after) < len(before)


def test_mix_and_pieces(stages):
    import public_tokenizers
    import sentencepiece

    before = rows_of(stages[3])
    mixed, target, held = plain_mix(before)
    assert rows_of(stages[4]) == sorted(mixed)
    size = {r[0]: len(r[1].split()) for r in before}
    largest = max(size.values())
    for source in target:
        taken = sum(size[r[0]] for r in mixed if r[3] == source)
        assert abs(taken - target[source]) <= 2 * largest
        assert target[source] <= 3 * held[source] + 1e-6
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = sorted((r.doc_id, r.source, r.n_tokens, tuple(r.ids), r.round_trip) for r in stages[5].collect())
    assert got == sorted((r[0], r[3], len(i), tuple(i), True) for r in mixed for i in [model.encode(r[1])])


def test_run_equals_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, rows.collect())) == sorted(map(str, stages[-1].collect()))


def test_odd_documents_pass_through(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(None, good, None, None, None), (1, None, "en", "a", 0), (1, "", "en", None, 0), (2, good, "en", "a", 5)]
    docs = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs.selectExpr("*", "1 as size", "2 as kept", "3 as row"), docs.filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            frame = staged(stage(spark, frame, SF_DIR), name)
        assert frame.count() <= 4
