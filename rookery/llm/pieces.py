"""SentencePiece encoding and decoding by a table of distinct chunks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.distinct import DistinctTable, packed
from rookery.llm.tables import quoted, row_of, utf8, with_row

# Fixed value: SentencePiece writes a space as this marker.
MARKER = "▁"
#: Distinct chunks a worker remembers.
TABLE_CHUNKS = 400_000
#: Rows handed on at once.
ROWS = 500


class ChunkCodec:
    """Encodes and decodes texts exactly as a SentencePiece model does, segmenting each distinct chunk once.

    A chunk is a run of markers and what follows up to the next marker.  Merges
    never cross its ends if no piece has a marker behind another character, so
    a text's ids are its chunks' ids in order.  Where the model has such pieces, changes
    its input (normalizer rules, white space removal) or adds no leading marker, whole texts are encoded.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        inner = any(MARKER in piece.lstrip(MARKER) for piece in pieces)
        special = any(
            not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
            and MARKER in piece and self.model.encode(piece.replace(MARKER, " ")) == [i]
            for i, piece in enumerate(pieces)
        )
        self.whole = inner or special or not self._keeps_input()
        self.starts_chunk = np.array([piece.startswith(MARKER) for piece in pieces])
        self.chunks = re.compile(f"{MARKER}+[^{MARKER}]*")
        self.simple = re.compile(f"{MARKER}[^{MARKER}]+")
        self.lead = self.model.encode("x")
        self.table = DistinctTable(self._encode_chunks, TABLE_CHUNKS)

    def _keeps_input(self) -> bool:
        """Whether the model leaves characters as they are and puts one marker in front."""
        probe = "  a  é é Ａ\t\n　 ­ x​ ① Aﬁ  "
        first = self.model.encode("a", out_type=str)
        return self.model.decode(self.model.encode(probe)) == probe and "".join(first) == MARKER + "a"

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without begin or end."""
        if self.whole or not text:
            return np.array(self.model.encode(text), np.int32)
        chunks = self.chunks.findall(MARKER + text.replace(" ", MARKER))
        return self.table.ids(chunks)

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Segment new chunks: those of one marker and a word all at once, where each starts at the next marker."""
        found: dict[str, bytes] = {}
        plain = [c for c in chunks if self.simple.fullmatch(c)]
        if plain:
            ids = np.array(self.model.encode("".join(plain)[1:].replace(MARKER, " ")), np.int32)
            starts = np.flatnonzero(self.starts_chunk[ids])
            if len(starts) != len(plain):
                raise ValueError("pieces cross the ends of chunks")
            data, ends = ids.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(ids)]
            found = {c: data[a:b] for c, a, b in zip(plain, (4 * starts).tolist(), ends)}
        for chunk in chunks:
            if chunk not in found:
                ids = self.model.encode("x" + chunk.replace(MARKER, " "))[len(self.lead) :]
                found[chunk] = packed(ids)
        return [found[c] for c in chunks]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


@lru_cache(maxsize=2)
def chunk_codec(model_file: str) -> ChunkCodec:
    """One codec per worker process, kept from task to task."""
    return ChunkCodec(model_file)


def encode_pieces(
    docs: DataFrame, model_file: str, keep: tuple[str, ...] | None = None, text_column: str = "text"
) -> DataFrame:
    """Every document with its ids and what they decode to: row (the columns of ``keep``, or all), ids, decoded.

    Texts are cut into chunks, a task segments each distinct chunk once, and a
    text's ids are gathered by the places of its chunks.  Exactly the model's
    own encoding, without begin or end ids.  Null text counts as empty and has
    no ids.  Texts of any length are encoded whole.  ``model_file`` must be readable on every executor.
    """
    carried = docs.select(row_of(docs, keep or docs.columns), F.col(quoted(text_column)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codec = chunk_codec(model_file)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                ids = [codec.encode(data.decode()) for data in utf8(batch.column(1))]
                decoded = [codec.decode(i) for i in ids]
                columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"])

    return carried.mapInArrow(run, with_row(carried, "ids array<int>, decoded string"))
