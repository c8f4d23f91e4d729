"""Token ids of a corpus as Parquet files that can be read by column and by page.

A file holds documents in ascending id order: ``doc_id``, ``part`` and ``row``
(the file's place and the document's place in it), ``n_tokens`` and ``ids``.
Ids are dictionary encoded (a vocabulary fits one dictionary page), the ascending
columns are delta encoded.  Row groups and pages are small enough that
the page index leads from a range of doc_id to the pages that hold it, and
n_tokens can be read without touching an id.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rookery.llm.distinct import DistinctTable, packed
from rookery.llm.tables import map_batches, utf8

#: Row groups of 32 MB, pages of 64 KB and at most 2,000 documents, delta encoding where no dictionary is used.
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#row": "false",
    "parquet.dictionary.page.size": str(1 << 20),
}
SCHEMA = "doc_id long, part int, row long, n_tokens long, ids array<int>"
#: Distinct words a worker remembers; of plain words, letters in lower case and marks apart.
TABLE_WORDS = 800_000
#: Rows handed on at once.
ROWS = 500


def _byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: itself if visible, else from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


# Letters whose lower case is one letter and which no normalization changes, then marks that split off as one run.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131\u0134-\u0148\u014a-\u017e"
_MARKS = ".,;:!?#$%&*|-"
_PLAIN = re.compile(rf"[{_LETTERS}]+[{_MARKS}]*")
_NOTHING = pa.scalar(b"", pa.large_binary())


def _parted(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Letters of plain words in lower case, and the marks behind them; other words whole, and nothing."""
    parts = pc.extract_regex(words, f"^(?P<letters>[{_LETTERS}]+)(?P<marks>[{_MARKS}]*)$")
    letters, marks = pc.struct_field(parts, "letters"), pc.struct_field(parts, "marks")
    return pc.coalesce(pc.utf8_lower(letters), words), pc.fill_null(marks, "")


class WordCodec:
    """Encodes texts exactly as a tokenizer of the tokenizers library, each distinct word once.

    Only for tokenizers whose tokens never contain or depend on ASCII white
    space (``splits_words`` tests it); others encode whole texts.  Words of
    plain letters, with or without marks behind, go to the vocabulary's merges
    at once if that gives the ids of the whole pipeline (``plain_words`` tests it);
    their letters and their marks are remembered apart, whatever the case.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.merges = self.tokenizer.model
        self.symbols = _byte_symbols()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.by_word = not any(t.lstrip or t.rstrip or t.single_word for t in added) and self.splits_words()
        self.table = DistinctTable(self._encode_words, TABLE_WORDS)
        self.plain = self.by_word and self.plain_words()

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def splits_words(self) -> bool:
        """Whether white space parts texts without leaving a trace in the ids."""
        words = ["The", "end's", "of", "3rd,", "\u00e1", "\u0301b", "na\u00efve", "\u201cq\u201d", "x", "\u2026"]
        apart = [i for w in words for i in self.whole(w)]
        joined = (" ", "\n", "\t \r\n", "  ", "\x0b", "\x0c")
        return all(self.whole(g + g.join(words) + g) == apart for g in joined)

    def plain_words(self) -> bool:
        """Whether plain words can go to the merges at once: tested on every letter and mark that they may hold."""
        letters = re.findall(f"[{_LETTERS}]", "".join(map(chr, range(0x180))))
        words = [f"{a}{b}{m}" for a, b, m in zip(letters, letters[7:] + letters[:7], _MARKS * 40)]
        words += [w + m for w in ("The", "nation", "\u00c9t\u00e9", "stra\u00dfe") for m in ("", ".", "...", "?!", "###", "-|")]
        heads, tails = _parted(pa.array(words))
        parts = [*zip(words, heads.to_pylist(), tails.to_pylist())]
        if any(head != word.lower().rstrip(_MARKS) for word, head, _ in parts):
            return False
        return all(self._plain_ids(w) == self.whole(w) == self.whole(head) + self.whole(tail) for w, head, tail in parts)

    def _plain_ids(self, word: str) -> list[int]:
        ids: list[int] = []
        lowered = word.lower()
        letters = lowered.rstrip(_MARKS)
        for part in (letters, lowered[len(letters) :]):
            if part:
                written = part if part.isascii() else "".join(map(self.symbols.__getitem__, part.encode()))
                ids += [token.id for token in self.merges.tokenize(written)]
        return ids

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        found: dict[bytes, bytes] = {}
        if self.plain:
            for word in words:
                text = word.decode()
                if _PLAIN.fullmatch(text):
                    found[word] = packed(self._plain_ids(text))
        others = [w for w in words if w not in found]
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)
        found.update((w, packed(e.ids)) for w, e in zip(others, encoded))
        return [found[w] for w in words]

    def _packed_ids(self, words: pa.Array) -> pa.Array:
        """Packed ids of all words, each distinct one looked up once."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        return pa.array(self.table.of_distinct(distinct), pa.large_binary()).take(coded.indices)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each text has; null counts as empty."""
        if not self.by_word:
            ids = [self.whole(data.decode()) for data in utf8(texts)]
            return np.fromiter(chain.from_iterable(ids), np.int32), np.array([len(i) for i in ids], np.int64)
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        if self.plain:
            packed_ids = pc.binary_join_element_wise(*map(self._packed_ids, _parted(coded.dictionary)), _NOTHING)
        else:
            packed_ids = self._packed_ids(coded.dictionary)
        found = packed_ids.take(coded.indices)
        ends = np.append(0, np.cumsum(pc.binary_length(found).to_numpy() // 4))
        at = np.append(0, np.cumsum(words.value_lengths().to_numpy()))
        return np.frombuffer(found.buffers()[2] or b"", np.int32, ends[-1]), np.diff(ends[at])

    def encode(self, data: bytes) -> np.ndarray:
        """Ids of a UTF-8 text."""
        return self.encode_all(pa.array([data.decode()]))[0]


@lru_cache(maxsize=2)
def word_codec(tokenizer_file: str) -> WordCodec:
    """One codec per worker process, kept from task to task."""
    return WordCodec(tokenizer_file)


def write_tokens(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode every whole text, append ``end_id``, write the files of the module's format.

    Null text counts as empty (its ids are the end id alone); null ids stand
    first; rows with equal ids stand side by side.  An empty table writes no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codec, part, row = word_codec(tokenizer_file), TaskContext.get().partitionId(), 0
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                ids, sizes = codec.encode_all(batch.column(1))
                n, ends = batch.num_rows, np.cumsum(sizes)
                lists = np.append(0, ends + np.arange(1, n + 1)).astype(np.int32)
                columns = [
                    batch.column(0),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.arange(row, row + n)),
                    pa.array(sizes + 1),
                    pa.ListArray.from_arrays(lists, np.insert(ids, ends, np.int32(end_id))),
                ]
                row += n
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "row", "n_tokens", "ids"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, row, n_tokens, start: where each document's ids lie, read without them.

    ``start`` counts the ids of all documents before: totals of the parts
    (one row each) are summed in order, then the documents within each part.
    """
    sizes = spark.read.schema(SCHEMA).parquet(path).select("doc_id", "part", "row", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inside.join(bases, F.col("part") == F.col("_part")).select(
        "doc_id", "part", "row", "n_tokens", (F.col("base") + F.col("inside")).alias("start")
    )


def read_tokens(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """doc_id, part, row, n_tokens, ids of the documents with ids in a range; other pages are skipped."""
    found = spark.read.schema(SCHEMA).parquet(path)
    if first_id is not None:
        found = found.filter(F.col("doc_id") >= first_id)
    return found if last_id is None else found.filter(F.col("doc_id") <= last_id)


def with_checksums(tokens: DataFrame) -> DataFrame:
    """part, row, ids_crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(np.append(0, ends[:-1]), ends)]
        columns = [batch.column("part"), batch.column("row"), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "row", "ids_crc32"])

    return map_batches(tokens.select("part", "row", "ids"), run, "part int, row long, ids_crc32 long")
