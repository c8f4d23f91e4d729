"""Removal of long byte strings that an earlier document holds too.

A byte goes if a string of LENGTH bytes that covers it also starts in a document
with a smaller id.  The work is cut at anchors.  The anchor of a string is its
run of CORE bytes with the smallest hash, so equal strings have equal anchors,
and the strings of one anchor occurrence start side by side: they lie in one
piece of at most 2 * LENGTH - CORE bytes.  Pieces meet by the hash of their anchor.

1. Equal texts become one document, that of the smallest id.
2. Every piece is described by two hashes, its document and place (`_anchor_blobs`).
   Columns of these travel as packed bytes, cut by ranges of the anchor's hash.
3. A range knows which anchors occur in several documents.  Where all their
   pieces are equal, their strings start first in the smallest of these documents.
   A range that one frequent anchor makes too large for a worker is not gathered:
   its verdicts are aggregates, joined back to its pieces (`_spread_entries`).
4. Of the other shared anchors one piece per distinct content is fetched.  A suffix
   array over them (`rookery.llm.suffix_array`) puts equal strings side by
   side; each class belongs to its smallest document.
5. Strings that start in a smaller document are marked, per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.suffix_array import suffix_array
from rookery.llm.tables import quoted, row_of, staged, utf8, with_row

LENGTH = 50
CORE = 24
#: Strings per window in which the smallest anchor is sought.
SPAN = LENGTH - CORE + 1
#: Bytes of text whose anchors are computed at once; longer texts are cut with an overlap.
BLOCK = 1 << 16
#: Entries a task gathers before it hands them to the ranges.
FLUSH_ENTRIES = 150_000
#: Text bytes for which there is one range of anchor hashes (about 300,000 entries).
RANGE_BYTES = 4_000_000
#: Entries of a range that one worker takes; a range with more is not gathered.
RANGE_ENTRIES = 600_000
#: Bytes of a row group of packed entries, which a task reads at once.
GROUP_BYTES = 16 << 20
#: Pieces of one suffix array task; anchors with more are spread over several.
TASK_PIECES = 20_000
#: Symbols of one suffix array.
ARRAY_SYMBOLS = 200_000

_U = np.uint64
_TABLE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, np.int64).astype(_U)
_FACTOR = 0x9E3779B97F4A7C15
_POSITION_BITS = 18


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def _doubled(start: np.ndarray, lengths: tuple[int, ...], join) -> list[np.ndarray]:
    """Values of windows of each length, built from windows of 1, 2, 4, ... elements."""
    powers = [start]
    while 2 << (len(powers) - 1) <= max(lengths):
        half = 1 << (len(powers) - 1)
        powers.append(join(powers[-1][:-half], powers[-1][half:], half))
    found = []
    for length in lengths:
        value, width = None, 0
        for k in reversed(range(len(powers))):
            if length >> k & 1:
                step = 1 << k
                if value is None:
                    value, width = powers[k], step
                else:
                    n = len(start) - width - step + 1
                    value = join(value[:n], powers[k][width : width + n], step)
                    width += step
        found.append(value)
    return found


def _poly(left: np.ndarray, right: np.ndarray, right_length: int) -> np.ndarray:
    return left * _U(pow(_FACTOR, right_length, 1 << 64)) + right


def _anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the strings of a block of joined texts: text, first, n, offset, core hash, piece hash.

    ``first`` is where the first of ``n`` strings with this anchor starts, in the block, and the anchor is
    ``offset`` bytes later.
    """
    cores, strings = _doubled(_TABLE[data], (CORE, LENGTH), _poly)
    cores = _mixed(cores)
    low = _U((1 << _POSITION_BITS) - 1)
    ranked = (cores & ~low) | np.arange(len(cores), dtype=_U)
    (least,) = _doubled(ranked, (SPAN,), lambda a, b, _: np.minimum(a, b))
    anchor = (least & low).astype(np.int64)
    # Strings must end within their text.
    inside = np.ones(len(anchor) + LENGTH, np.int8)
    begins = np.append(0, ends[:-1])
    for k in range(1, LENGTH):
        inside[np.maximum(ends - k, begins)] = 0
    inside = inside[: len(anchor)].astype(bool)
    change = np.empty(len(anchor), bool)
    change[0] = True
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    after = np.append(first[1:], len(anchor))
    held = inside[first]
    first, after = first[held], after[held]
    at = anchor[first]
    n, offset = after - first, at - first
    shape = (n * 256 + offset).astype(_U)
    piece = _mixed(strings[first] * _U(0xC2B2AE3D27D4EB4F) + _mixed(strings[after - 1] + shape))
    text = np.searchsorted(ends, first, side="right")
    return text, first, n, offset, cores[at], piece


def _blocks(texts: Iterator[tuple[object, bytes]]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of about BLOCK bytes: keys, joined bytes, ends, and where each part starts in its own text."""
    keys, parts, starts, held = [], [], [], 0
    for key, data in texts:
        for start in range(0, len(data) - LENGTH + 1, BLOCK):
            part = data[start : start + BLOCK + LENGTH - 1]
            keys.append(key)
            parts.append(part)
            starts.append(start)
            held += len(part)
            if held >= BLOCK:
                yield keys, np.frombuffer(b"".join(parts), np.uint8), np.cumsum(list(map(len, parts))), np.array(starts)
                keys, parts, starts, held = [], [], [], 0
    if parts:
        yield keys, np.frombuffer(b"".join(parts), np.uint8), np.cumsum(list(map(len, parts))), np.array(starts)


#: Packed entry: name and bytes kept, least significant first.
_FIELDS = (("doc", 8), ("ord", 4), ("start", 4), ("n", 1), ("offset", 1), ("core", 6), ("piece", 6))


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    """Entries as one compressed byte string, byte by byte; documents as differences."""
    out = []
    for name, width in _FIELDS:
        values = columns[name].astype(np.int64)
        if name == "doc":
            values = np.diff(values, prepend=0)
        out.append(values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.compress(b"".join(out), 1)


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n = len(raw) // sum(width for _, width in _FIELDS)
    found, at = {}, 0
    for name, width in _FIELDS:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = raw[at : at + n * width].reshape(width, n).T
        found[name] = wide.view(np.int64).reshape(n)
        at += n * width
    found["doc"] = np.cumsum(found["doc"])
    return found


def _anchor_blobs(texts: DataFrame, ranges: int, packed: bool = True) -> DataFrame:
    """range, entries, blob: the pieces of all texts (doc, ord, text), by range of the anchor's hash.

    The pieces are counted only, if not ``packed``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            core = (columns[5] >> _U(16)).view(np.int64)
            piece = (columns[6] >> _U(16)).view(np.int64)
            # Anchors are smallest hashes: dealt evenly only by a hash of their hash.
            place = ((_mixed(columns[5]) >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)
            # Copies of a piece within a document, or in a later one, add nothing but their place, which is needed: all stay.
            order = np.argsort(place, kind="stable")
            names = [name for name, _ in _FIELDS]
            values = [c[order] for c in (*columns[:5], core, piece)]
            cuts = np.flatnonzero(np.diff(place[order], prepend=-1))
            after = np.append(cuts[1:], len(order))
            blobs = [
                _pack(dict(zip(names, (v[a:b] for v in values)))) if packed else None for a, b in zip(cuts, after)
            ]
            columns = (place[order][cuts], after - cuts)
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array(blobs, pa.binary())], ["range", "entries", "blob"]
            )

        count = 0
        for batch in batches:
            docs, ords = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for keys, data, ends, starts in _blocks(zip(zip(docs, ords), utf8(batch.column(2)))):
                text, first, n, offset, core, piece = _anchors(data, ends)
                doc, place = np.array(keys, np.int64).T
                begins = np.append(0, ends[:-1])
                held.append((doc[text], place[text], first - begins[text] + starts[text], n, offset, core, piece))
                count += len(text)
                if count >= FLUSH_ENTRIES:
                    yield flush()
                    count = 0
        if count:
            yield flush()

    return texts.mapInArrow(run, "range long, entries long, blob binary")


ENTRY = "doc long, ord int, start int, n int, offset int, core long, piece long, variants int, first boolean"


def _shared_entries(blobs: DataFrame) -> DataFrame:
    """Pieces whose strings may start in a smaller document.

    ``variants`` is 1 where all pieces of the anchor are equal: the strings of
    this piece do start in a smaller document.  Else it is the number of
    distinct pieces of the anchor; ``first`` marks one of each, in its smallest document.
    """

    def run(group: pa.Table) -> pa.Table:
        parts = [_unpack(blob) for blob in group.column("blob").to_pylist()]
        e = {name: np.concatenate([p[name] for p in parts]) for name, _ in _FIELDS}
        order = np.lexsort((e["ord"], e["doc"], e["piece"], e["core"]))
        e = {name: values[order] for name, values in e.items()}
        new_core = np.append(True, np.diff(e["core"]) != 0)
        new_piece = new_core | np.append(True, np.diff(e["piece"]) != 0)
        core_id, starts = np.cumsum(new_core) - 1, np.flatnonzero(new_core)
        least = np.minimum.reduceat(e["doc"], starts)[core_id]
        most = np.maximum.reduceat(e["doc"], starts)[core_id]
        variants = np.add.reduceat(new_piece.astype(np.int64), starts)[core_id]
        wanted = (least != most) & ((variants > 1) | (e["doc"] > least))
        columns = [e[name][wanted] for name in ("doc", "ord", "start", "n", "offset", "core", "piece")]
        kinds = [pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        values = [*columns, variants[wanted], (new_piece & (variants > 1))[wanted]]
        return pa.table([pa.array(v, k) for v, k in zip(values, kinds)], [c.split()[0] for c in ENTRY.split(", ")])

    return blobs.select("range", "blob").groupBy("range").applyInArrow(run, ENTRY)


PLACE = ("doc", "ord", "start", "n", "offset")


def _spread_entries(blobs: DataFrame) -> DataFrame:
    """The same as `_shared_entries`, where a range may hold any number of pieces of one anchor.

    No task gathers an anchor: copies of a piece, then pieces of an anchor, collapse in the map tasks, and
    the joins of the verdict with the pieces are split at run time where an anchor is frequent.
    """
    kinds = [pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64()]
    names = (*PLACE, "core", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                e = _unpack(blob)
                yield pa.RecordBatch.from_arrays([pa.array(e[name], k) for name, k in zip(names, kinds)], list(names))

    entries = blobs.select("blob").mapInArrow(run, ENTRY.split(", variants")[0])
    pieces = entries.groupBy("core", "piece").agg(F.min(F.struct(*PLACE)).alias("head"), F.max("doc").alias("most"))
    pieces = staged(pieces, "distinct-pieces")
    anchors = pieces.groupBy("core").agg(
        F.count(F.lit(1)).cast("int").alias("variants"), F.min("head.doc").alias("least"), F.max("most").alias("most")
    )
    # Staged, so that each join exchanges both sides and can be split.
    anchors = staged(anchors.filter("least != most").drop("most"), "shared-anchors")
    anchors = anchors.withColumnRenamed("core", "_core")
    same = F.col("core") == F.col("_core")
    heads = pieces.join(anchors.filter("variants > 1"), same).select(*(f"head.{c}" for c in PLACE), "core", "piece", "variants")
    heads = staged(heads, "first-pieces")
    taken = heads.select(*(F.col(c).alias(f"_{c}") for c in PLACE[:3]))
    others = (
        entries.join(anchors, same)
        .filter("variants > 1 OR doc > least")
        .select(*names, "variants")
        .join(taken, [F.col(c) == F.col(f"_{c}") for c in PLACE[:3]], "left_anti")
    )
    return heads.withColumn("first", F.lit(True)).union(others.withColumn("first", F.lit(False)))


def _big_ranges(blobs: DataFrame, range_entries: int) -> DataFrame:
    """Ranges with more entries than one worker takes."""
    return blobs.groupBy("range").agg(F.sum("entries").alias("held")).filter(F.col("held") > range_entries).select("range")


def _extents(contexts: list[bytes]) -> list[int]:
    """For each context how many leading bytes another one of the list shares."""
    order = sorted(range(len(contexts)), key=contexts.__getitem__)
    found = [0] * len(contexts)
    for i, j in zip(order, order[1:]):
        a, b = contexts[i], contexts[j]
        n, most = 0, min(len(a), len(b))
        if a[:most] == b[:most]:
            n = most
        else:
            while a[n] == b[n]:
                n += 1
        found[i], found[j] = max(found[i], n), max(found[j], n)
    return found


def string_classes(strings: list[np.ndarray], owners: list[int]) -> list[np.ndarray]:
    """For each string of symbols, the smallest owner of each of its windows of SPAN symbols, by suffix array."""
    ends = np.cumsum([len(s) + 1 for s in strings])
    text = np.zeros(ends[-1] + 1, np.int64)
    owner = np.repeat(np.array(owners, np.int64), [len(s) + 1 for s in strings])
    window = np.ones(len(owner), bool)
    for s, end in zip(strings, ends):
        text[end - 1 - len(s) : end - 1] = s
        text[end - 1] = 1
        window[max(end - SPAN, end - 1 - len(s)) : end] = False
    order = suffix_array(text)
    order = order[order < len(owner)]
    order = order[window[order]]
    least = np.zeros(len(owner), np.int64)
    if len(order):
        views = np.lib.stride_tricks.sliding_window_view(text, SPAN)
        same = np.append(False, (views[order[1:]] == views[order[:-1]]).all(1))
        starts = np.flatnonzero(~same)
        least[order] = np.minimum.reduceat(owner[order], starts)[np.cumsum(~same) - 1]
    return [least[end - 1 - len(s) : max(end - SPAN, end - 1 - len(s))] for s, end in zip(strings, ends)]


OWNERS = "core long, piece long, owners array<long>, strings array<binary>"


def _owners_of_windows(core: bytes, rows: list[tuple], trim: bool) -> tuple[list, list, list]:
    """Strings of one anchor, what is kept of each piece, and which string it is."""
    lefts = [data[offset - 1 :: -1] if offset else b"" for _, data, _, offset in rows]
    rights = [data[offset + CORE :] for _, data, _, offset in rows]
    left_most = _extents(lefts) if trim else [len(x) for x in lefts]
    right_most = _extents(rights) if trim else [len(x) for x in rights]
    strings: dict[bytes, int] = {}
    owners: list[int] = []
    places = []
    for (doc, _, n, offset), left, right, lm, rm in zip(rows, lefts, rights, left_most, right_most):
        # String i starts offset - i bytes before the anchor and ends SPAN - 1 - (offset - i) behind it.
        low, high = max(0, offset - lm), min(n, rm - (SPAN - 1) + offset + 1)
        if low >= high:
            places.append(None)
            continue
        kept = left[: offset - low][::-1] + b"\0" + right[: SPAN - 1 - (offset - (high - 1))]
        key = (offset - low).to_bytes(1, "big") + kept
        at = strings.setdefault(key, len(owners))
        if at == len(owners):
            owners.append(doc)
        owners[at] = min(owners[at], doc)
        places.append((at, low, high))
    return list(strings), owners, places


def _window_owners(pieces: DataFrame, whole: bool = True) -> DataFrame:
    """core, piece, owners: the smallest document of each string of a piece, as far as the group shows.

    ``pieces`` has group, doc, data, n, offset, core, piece.  Bytes that no
    other piece of the anchor continues with cannot be part of a shared string
    and are cut off first; what then is equal is one string.  The anchor
    becomes a single symbol, so a string of LENGTH bytes is one of SPAN symbols.
    If groups don't hold ``whole`` anchors nothing is cut off, and ``strings`` holds the strings themselves.
    """

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pydict()
        by_core: dict[bytes, list[int]] = {}
        for i, (data, offset) in enumerate(zip(rows["data"], rows["offset"])):
            by_core.setdefault(data[offset : offset + CORE], []).append(i)
        owners: list[np.ndarray | None] = [None] * len(rows["data"])
        strings, docs, waiting = [], [], []

        def settle() -> None:
            classes = string_classes(strings, docs) if strings else []
            for i, at, low, high in waiting:
                owners[i] = np.full(rows["n"][i], rows["doc"][i], np.int64)
                owners[i][low:high] = classes[at]
            for held in (strings, docs, waiting):
                held.clear()

        size = 0
        for symbol, (core, members) in enumerate(by_core.items()):
            held = [(rows["doc"][i], rows["data"][i], rows["n"][i], rows["offset"][i]) for i in members]
            found, least, places = _owners_of_windows(core, held, whole)
            base = len(strings)
            for key in found:
                at = key[0]
                symbols = np.frombuffer(key, np.uint8, offset=1).astype(np.int64) + 2
                symbols[at] = 258 + symbol
                strings.append(symbols)
                size += len(symbols) + 1
            docs.extend(least)
            waiting.extend((i, base + p[0], p[1], p[2]) for i, p in zip(members, places) if p)
            if size >= ARRAY_SYMBOLS:
                settle()
                size = 0
        settle()
        full = [[rows["doc"][i]] * rows["n"][i] if o is None else o for i, o in enumerate(owners)]
        texts = [
            None if whole else [data[k : k + LENGTH] for k in range(n)] for data, n in zip(rows["data"], rows["n"])
        ]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()))
        columns = (rows["core"], rows["piece"], full, texts)
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["core", "piece", "owners", "strings"]
        )

    return pieces.groupBy("group").applyInArrow(run, OWNERS)


def _fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """group, doc, data, n, offset, core, piece: the bytes of the wanted pieces."""
    lists = wanted.groupBy("doc", "ord").agg(
        F.collect_list(F.struct("start", "n", "offset", "core", "piece", "group")).alias("wanted")
    )
    joined = texts.join(lists.withColumnsRenamed({"doc": "_doc", "ord": "_ord"}), (F.col("doc") == F.col("_doc")) & (F.col("ord") == F.col("_ord")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("group", "n", "offset", "core", "piece")
        for batch in batches:
            lists = batch.column("wanted")
            flat = lists.flatten()
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            starts, sizes = flat.field("start").to_pylist(), flat.field("n").to_pylist()
            data, at = [], 0
            for text, count in zip(utf8(batch.column("text")), counts):
                data += [text[a : a + n + LENGTH - 1] for a, n in zip(starts[at : at + count], sizes[at : at + count])]
                at += count
            docs = np.repeat(batch.column("doc").to_numpy(zero_copy_only=False), counts)
            arrays = [pa.array(docs, pa.int64()), pa.array(data, pa.binary()), *(flat.field(n) for n in names)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc", "data", *names])

    return joined.select("doc", "text", "wanted").mapInArrow(
        run, "doc long, data binary, group long, n int, offset int, core long, piece long"
    )


def _met_owners(local: DataFrame) -> DataFrame:
    """core, piece, owners of anchors whose pieces were spread over several groups: owners meet by string."""
    single = local.select("core", "piece", F.posexplode(F.arrays_zip("owners", "strings")).alias("i", "s")).select(
        "core", "piece", "i", F.col("s.owners").alias("owner"), F.col("s.strings").alias("string")
    )
    single = staged(single, "spread-strings")
    least = single.groupBy("core", "string").agg(F.min("owner").alias("least"))
    least = least.withColumnsRenamed({"core": "_core", "string": "_string"})
    met = single.join(least, (F.col("core") == F.col("_core")) & (F.col("string") == F.col("_string")))
    rows = met.groupBy("core", "piece").agg(F.sort_array(F.collect_list(F.struct("i", "least"))).alias("by_place"))
    return rows.select("core", "piece", F.col("by_place.least").alias("owners"))


def _marks(texts: DataFrame, total_bytes: int, range_bytes: int, task_pieces: int, range_entries: int) -> DataFrame:
    """doc, ord, marks: the strings of each text that start in a smaller document, as (start, mask) pairs.

    Bit i of a mask stands for the string that starts at start + i.
    """
    ranges = max(1, -(-total_bytes // range_bytes))
    # Counted apart: to keep all packed pieces for a second reading would cost about the input's size in disk.
    big = staged(_big_ranges(_anchor_blobs(texts, ranges, packed=False), range_entries), "big-ranges")
    blobs = _anchor_blobs(texts, ranges)
    if big.isEmpty():
        entries = _shared_entries(blobs)
    else:
        frequent = blobs.join(big, "range", "left_semi")
        frequent = staged(frequent, "packed-pieces", {"parquet.block.size": str(GROUP_BYTES)})
        entries = _shared_entries(blobs.join(big, "range", "left_anti")).union(_spread_entries(frequent))
    entries = staged(entries, "shared-pieces")
    many = F.col("variants") > task_pieces
    n_first, n_many = entries.filter("first").agg(F.count(F.lit(1)), F.count_if(many)).first()
    groups = max(1, -(-n_first // task_pieces))
    salt = F.pmod("piece", F.ceil(F.col("variants") / task_pieces))
    group = F.when(many, F.xxhash64("core", salt)).otherwise(F.pmod("core", F.lit(groups)))
    wanted = entries.filter("first").withColumn("group", group.cast("long")).withColumn("spread", many)
    owners = _window_owners(_fetched(texts, wanted.filter(~many))).select("core", "piece", "owners")
    if n_many:
        owners = owners.union(_met_owners(_window_owners(_fetched(texts, wanted.filter(many)), whole=False)))
    owners = staged(owners, "owners").withColumnsRenamed({"core": "_core", "piece": "_piece"})
    later = F.expr(
        "aggregate(transform(owners, (o, i) -> if(o < doc, shiftleft(1L, i), 0L)), 0L, (a, x) -> a + x)"
    )
    compared = (
        entries.filter("variants > 1")
        .join(owners, (F.col("core") == F.col("_core")) & (F.col("piece") == F.col("_piece")))
        .select("doc", "ord", "start", later.alias("mask"))
        .filter("mask != 0")
    )
    equal = entries.filter("variants = 1").select("doc", "ord", "start", F.expr("shiftleft(1L, n) - 1").alias("mask"))
    return compared.union(equal).groupBy("doc", "ord").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))


def _covered(n_bytes: int, starts: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which bytes the marked strings cover."""
    rows, bits = np.nonzero((masks[:, None] >> np.arange(SPAN)) & 1)
    first = starts[rows] + bits
    change = np.zeros(n_bytes + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame,
    keep: tuple[str, ...] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = False,
    range_bytes: int = RANGE_BYTES,
    task_pieces: int = TASK_PIECES,
    range_entries: int = RANGE_ENTRIES,
) -> DataFrame:
    """Every document without what a smaller one holds: row, n_bytes, n_removed, n_spans, kept_sha256, kept, kept_text.

    ``row`` holds the columns of ``keep`` (all, if None) but the text; ``kept``
    the remaining bytes and ``kept_text`` their text, without the rest of characters
    that a cut parts, if ``with_text`` (null without).  Strings are judged on
    the input.  Null text counts as empty.  A row without id takes no part:
    nothing is removed from it or because of it.  Rows with equal ids remove nothing from each
    other.  Of equal texts the smallest id is kept whole and no other is compared.
    Texts below LENGTH bytes stay whole.  An empty table gives no rows.
    """
    text = F.col(quoted(text_column))
    others = [c for c in (keep or docs.columns) if c != text_column]
    base = docs.select(
        row_of(docs, others),
        F.col(quoted(id_column)).cast("long").alias("doc"),
        text.alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
    )
    same_doc = Window.partitionBy("doc").orderBy("t1", "t2")
    firsts = (
        base.filter(F.col("doc").isNotNull() & (F.col("n_bytes") >= LENGTH))
        .groupBy("t1", "t2", "n_bytes")
        .agg(F.min("doc").alias("doc"))
        .withColumn("ord", (F.row_number().over(same_doc) - 1).cast("int"))
    )
    firsts = staged(firsts, "distinct-texts")
    total = firsts.agg(F.sum("n_bytes")).first()[0] or 0
    keys = ("doc", "t1", "t2")
    renamed = firsts.select(*(F.col(k).alias(f"_{k}") for k in keys), "ord")
    matched = [F.col(k) == F.col(f"_{k}") for k in keys]
    texts = base.join(renamed, matched).select(*keys, "ord", "text").dropDuplicates(list(keys))
    marks = _marks(texts.select("doc", "ord", "text"), total, range_bytes, task_pieces, range_entries)
    marks = marks.withColumnsRenamed({"doc": "_doc", "ord": "_ord"})
    verdicts = firsts.join(marks, (F.col("doc") == F.col("_doc")) & (F.col("ord") == F.col("_ord")), "left").select(
        *(F.col(k).alias(f"_{k}") for k in keys), F.coalesce("marks", F.array()).alias("marks")
    )
    verdicts = staged(verdicts, "repeat-marks")
    judged = base.join(verdicts, matched, "left").select("row", "doc", "text", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = batch.column("marks")
            known = lists.is_valid().to_pylist()
            counts = lists.fill_null([]).value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            starts = flat.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
            masks = flat.field("mask").to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            for doc, data, has, count in zip(batch.column("doc").to_pylist(), utf8(batch.column("text")), known, counts):
                gone = None
                if doc is not None and len(data) >= LENGTH:
                    if not has:
                        gone = np.ones(len(data), bool)
                    elif count:
                        gone = _covered(len(data), starts[at : at + count], masks[at : at + count])
                at += count
                kept, removed, spans = data, 0, 0
                if gone is not None:
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                digest = hashlib.sha256(kept).hexdigest()
                texts = (kept, kept.decode("utf-8", "ignore")) if with_text else (None, None)
                rows.append((len(data), removed, spans, digest, *texts))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())
            columns = list(zip(*rows)) or [[]] * 6
            names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    more = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string"
    return judged.mapInArrow(run, with_row(base, more))
