from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rookery.llm import distinct, pieces, token_files
from rookery.session import scratch_path

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b ", "▁x ▁", "a▁▁b", "<s> </s> <unk>", "\n\n x\t y\r\x0b\x0c z",
    "日本 語\U0001f600 한국", "\x00 \x00", "á e ́a é", "Don't I'LL x's 's '", "<|endoftext|> a<|startoftext|>b",
    "a b\x1cc d", "12 3½ ①Ⅳ", "ΑΣ ΣΑΣ. İstanbul", "the THE The", "x" * 3000, "word " * 30000, "q" * 70, "​ ﻿ ﬁ",
]


def mixed_texts():
    rng = random.Random(4)
    alphabet = "abcdeé  \n\t.,'▁ß漢́ 12"
    return TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]


def test_pieces_equal_the_library(spark, make_docs):
    texts = mixed_texts()
    docs = make_docs(texts).selectExpr("*", "1 as ids", "2 as decoded", "3 as row")
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    found = pieces.encode_pieces(docs, PIECE_FILE).collect()
    assert len(found) == len(texts)
    for r in found:
        want = model.encode(r.row.text or "")
        assert list(r.ids) == want and r.decoded == model.decode(want)
    assert pieces.encode_pieces(docs.filter("false"), PIECE_FILE).collect() == []


def test_chunk_table_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 5)
    codec = pieces.ChunkCodec(PIECE_FILE)
    assert not codec.whole
    for text in mixed_texts():
        assert codec.encode(text or "").tolist() == codec.model.encode(text or "")


def test_word_table_equals_the_library(monkeypatch):
    model = Tokenizer.from_file(WORD_FILE)
    for most in (5, 10**6):
        monkeypatch.setattr(token_files, "TABLE_WORDS", most)
        codec = token_files.WordCodec(WORD_FILE)
        assert codec.by_word and codec.plain
        for text in mixed_texts():
            assert codec.encode((text or "").encode()).tolist() == model.encode(text or "", add_special_tokens=False).ids


def test_plain_words_equal_the_library():
    codec, rng = token_files.WordCodec(WORD_FILE), random.Random(8)
    letters = "".join(c for c in map(chr, range(0x180)) if token_files._PLAIN.fullmatch(c))
    for _ in range(3000):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + "".join(
            rng.choice(".,;:!?#$%&*|-") for _ in range(rng.randrange(4))
        )
        assert token_files._PLAIN.fullmatch(word) and codec._plain_ids(word) == codec.whole(word), word


@pytest.fixture(scope="module")
def corpus():
    ids = [None, 5, 5, -3, *range(1000, 1000 + len(mixed_texts()) - 4)]
    random.Random(2).shuffle(ids)
    return list(zip(ids, mixed_texts()))


def test_files_hold_all_ids_in_order(spark, make_docs, corpus):
    docs = make_docs([(i, t, "en", "s") for i, t in corpus]).selectExpr("*", "1 as n_tokens", "2 as part")
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs.repartition(3), path, WORD_FILE, end_id=1)
    model = Tokenizer.from_file(WORD_FILE)
    rows = token_files.read_documents(spark, path).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in corpus), key=lambda i: (i is not None, i or 0))
    ends = np.cumsum([r.n_tokens for r in rows]).tolist()
    assert [r.start for r in rows] == [0, *ends[:-1]]
    ids = {(r.part, r.row): list(r.ids) for r in token_files.read_tokens(spark, path).collect()}
    sums = {(r.part, r.row): r.ids_crc32 for r in token_files.with_checksums(token_files.read_tokens(spark, path)).collect()}
    want = sorted((str(i), [*model.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in corpus)
    assert sorted((str(r.doc_id), ids[r.part, r.row]) for r in rows) == want
    assert all(sums[k] == zlib.crc32(np.array(v, "<u4").tobytes()) for k, v in ids.items())
    some = token_files.read_tokens(spark, path, 1000, 1004)
    assert sorted(r.doc_id for r in some.collect()) == [1000, 1001, 1002, 1003, 1004]
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,1000)" in some._jdf.queryExecution().toString()


def test_file_layout(spark, make_docs, corpus):
    import glob

    import pyarrow.parquet as pq

    path = scratch_path(spark, "tokens")
    token_files.write_tokens(make_docs([(i, f"t{i} x", "en", "s") for i in range(3000)]), path, WORD_FILE, end_id=1)
    file = next(f for f in glob.glob(path.removeprefix("file://") + "/*.parquet") if pq.ParquetFile(f).metadata.num_rows)
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())


def test_no_rows(spark, make_docs):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(make_docs(["x"]).filter("false"), path, WORD_FILE, end_id=1)
    assert token_files.read_documents(spark, path).filter(F.lit(True)).collect() == []


def test_table_of_chunks_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(distinct, "LIMIT", 4000)
    calls = []

    def encode(chunks):
        calls.extend(chunks)
        return [distinct.packed([ord(x) for x in c]) for c in chunks]

    held = distinct.DistinctTable(encode, 1_000_000)
    long = "x" * (distinct.CHUNK + 1)
    for number in range(400):
        chunks = [f"{number}", long, "a", long, f"{number % 7}"]
        assert held.ids(chunks).tolist() == [ord(c) for chunk in chunks for c in chunk]
        stored = [*held.known, *held.recent]
        assert long not in stored
        assert 4 * sum(map(len, stored)) + sum(map(len, [*held.known.values(), *held.recent.values()])) < 4000 * 2
    assert calls.count("a") == 1 and calls.count(long) == 400 and len(held.known) < 400


def test_long_words_without_spaces(spark):
    text = "\u4e2d\u6587" * 3000
    docs = spark.createDataFrame([(i, (text + str(i) + " ") * 3) for i in range(4)], "doc_id long, text string")

    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    for row in pieces.encode_pieces(docs, model).collect():
        assert row.ids == library.encode(row.row.text)
    codec = pieces.ChunkCodec(model)
    codec.encode(text)
    assert not codec.table.known and not codec.table.recent


def test_words_that_differ_in_case_and_marks_are_encoded_once():
    codec, calls = token_files.WordCodec(WORD_FILE), []
    encode = codec.table.encode
    codec.table.encode = lambda words: calls.extend(words) or encode(words)
    for text in ("Nation, nation NATION... nation", "", "Été. été nation?! it's 3rd,", " nation,\n"):
        assert codec.encode(text.encode()).tolist() == codec.whole(text)
    assert sorted(w.decode() for w in calls if w) == sorted(["nation", "été", ",", ".", "...", "?!", "it's", "3rd,"])


def test_nulls_slices_and_no_texts():
    codec, texts = token_files.WordCodec(WORD_FILE), [None, "Nation, a", "", " nation,\n", None]
    ids, sizes = codec.encode_all(pa.array(["left out", *texts, "left out"]).slice(1, len(texts)))
    want = [codec.whole(t or "") for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]
    for none in (pa.array([], pa.string()), pa.array([None, " "])):
        ids, sizes = codec.encode_all(none)
        assert ids.tolist() == [] and sizes.tolist() == [0] * len(none)


def test_texts_of_a_batch_equal_the_library(monkeypatch):
    texts = pa.array(mixed_texts() * 2)
    whole = token_files.WordCodec(WORD_FILE)
    want = [whole.whole(t or "") for t in texts.to_pylist()]
    for most, plain, by_word in ((5, True, True), (10**6, True, True), (50, False, True), (5, False, False)):
        monkeypatch.setattr(token_files, "TABLE_WORDS", most)
        codec = token_files.WordCodec(WORD_FILE)
        codec.plain, codec.by_word = plain, by_word
        for values in (texts, texts.cast(pa.large_string())):
            ids, sizes = codec.encode_all(values)
            assert sizes.tolist() == [len(w) for w in want]
            assert ids.dtype == np.int32 and ids.tolist() == [i for w in want for i in w]
