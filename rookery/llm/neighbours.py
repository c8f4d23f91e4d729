"""Approximate nearest neighbours by inner product: inverted lists, scanned in column blocks of rotated vectors.

Each distinct vector is scaled to at most unit length, given one more coordinate that
brings it to unit length, rotated at random and put into the list of its nearest
centre.  The distance to a unit query then orders by inner product.  A query probes its nearest
lists; within a list, distances grow by one block of coordinates at a time.  After
each block a hypothesis test drops the candidates whose distance so far, over a random
share of the coordinates, makes it improbable that they are among the best.  What is
left is scored exactly on the original vectors.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StructField, StructType

from rookery.llm.tables import quoted, staged

#: Distinct vectors on which centres are fitted and the number of probed lists is chosen.
SAMPLE_ROWS = 16_384
#: Share of the true neighbours, within the sample, that the probed lists must hold.
TARGET = 0.96
#: Coordinates (vectors x dimensions) of a chunk of the index, 1 MB rotated; queries that meet it at once.
CHUNK_NUMBERS = 1 << 18
QUERY_ROWS = 512
#: Coordinates between two tests, and candidates between two updates of the scores to beat.
BLOCK_COLUMNS = 16
STEP_ROWS = 1024
#: Width of the test: a candidate goes when its distance over d coordinates is above (1 + EPSILON / sqrt d)^2 its share.
EPSILON = 2.1
#: Rounding of 32-bit products of unit vectors stays far below this.
SLACK = 1e-5
#: Query chunks whose scores to beat a task remembers, 4 KB each.
REMEMBERED = 256

INDEX = "chunk long, n int, held array<int>, keys binary, lists binary, flags binary, vectors binary, rotated binary"
QUERIES = "q long, q_n int, probed array<int>, q_keys binary, q_vectors binary, q_beat binary, q_probes binary"
FOUND = "q1 long, q2 long, c1 long, c2 long, score double"


@dataclass(frozen=True)
class Index:
    """What is fitted on the sample: longest length, rotation, centres, probed lists, and parts that lists are dealt to."""

    dims: int
    kind: str
    longest: float
    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    sampled: np.ndarray
    least: int
    first_part: np.ndarray
    n_parts: np.ndarray

    def rotated(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Rotated unit vectors: queries by their own length, candidates by the additional coordinate."""
        if query:
            scaled = vectors / np.abs(vectors).max(1, keepdims=True)
            more = np.zeros(len(vectors))
            scaled = scaled / np.sqrt((scaled**2).sum(1, keepdims=True))
        else:
            scaled = vectors / self.longest
            more = np.sqrt(np.maximum(1.0 - (scaled**2).sum(1), 0.0))
        return (np.column_stack([scaled, more]) @ self.rotation).astype(np.float32)

    def closeness(self, rotated: np.ndarray) -> np.ndarray:
        """Larger for nearer centres."""
        return rotated @ self.centres.T - 0.5 * (self.centres**2).sum(1)

    def lists(self, rotated: np.ndarray) -> np.ndarray:
        return self.closeness(rotated).argmax(1)

    def probed(self, rotated: np.ndarray) -> np.ndarray:
        """Which lists each query probes: the nearest ones, and more until they hold ``least`` sampled vectors."""
        order = np.argsort(-self.closeness(rotated), axis=1)
        short = np.cumsum(self.sampled[order], axis=1) < self.least
        # A list is probed as long as those before it are too few.
        wanted = np.arange(order.shape[1])[None, :] < np.maximum(self.probes, short.sum(1) + 1)[:, None]
        found = np.zeros(order.shape, bool)
        np.put_along_axis(found, order, wanted, axis=1)
        return found


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(lists), dims), flat.dtype)
    at = np.repeat(np.arange(len(lists)), sizes)
    found[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return found


def comparable_vectors(vectors: DataFrame, query: Column, id_column: str, vector_column: str) -> DataFrame:
    """id, query, vec, k1, k2 of the rows that take part; k1 and k2 are a hash of 128 bits that stands for a vector."""
    given = vectors.schema[vector_column].dataType
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    vec = F.col(quoted(vector_column)).cast("array<float>" if single else "array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    part = vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0) & F.col(quoted(id_column)).isNotNull()
    return vectors.filter(F.coalesce(part, F.lit(False))).select(
        F.col(quoted(id_column)).cast("long").alias("id"),
        F.coalesce(query, F.lit(False)).alias("query"),
        vec.alias("vec"),
        F.xxhash64(vec).alias("k1"),
        F.xxhash64(F.lit(1), vec).alias("k2"),
    )


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Most coordinates and largest length of a task's vectors."""
    dims, longest = 0, 0.0
    for batch in batches:
        lists = batch.column(0)
        if not len(lists):
            continue
        width = pc.max(pc.list_value_length(lists)).as_py() or 0
        vectors = _matrix(lists, width).astype(float)
        largest = np.abs(vectors).max(1, keepdims=True)
        lengths = largest[:, 0] * np.sqrt(((vectors / largest) ** 2).sum(1))
        dims, longest = max(dims, width), max(longest, float(lengths.max()))
    if dims:
        yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([longest])], ["dims", "longest"])


def fit_index(rows: DataFrame, distinct: int, k: int) -> Index | None:
    """Centres, rotation and number of probed lists from a sample of SAMPLE_ROWS of the distinct vectors at most.

    The sample holds the vectors whose hash is below a bound, all of them in a small table.  Lists
    grow with the root of the distinct vectors, up to one for 16 sampled vectors.
    """
    profile = rows.select("vec").mapInArrow(_lengths, "dims int, longest double").agg(F.max("dims"), F.max("longest"))
    dims, longest = profile.first()
    if not dims:
        return None
    share = min(1.0, 0.8 * SAMPLE_ROWS / distinct)
    below = F.lit(int(-(2**63) + share * (2**64 - 1))) if share < 1 else F.lit(2**63 - 1)
    spread = F.xxhash64(F.lit(2), "vec")
    picked = rows.filter(spread <= below).groupBy("vec").agg(F.min(spread).alias("at")).limit(SAMPLE_ROWS).collect()
    kind = "float32" if rows.schema["vec"].dataType.elementType == FloatType() else "float64"
    sample = np.zeros((len(picked), dims))
    for place, row in enumerate(sorted(picked, key=lambda r: (r.at, r.vec))):
        sample[place, : len(row.vec)] = row.vec
    rng = np.random.default_rng(20)
    rotation = np.linalg.qr(rng.normal(size=(dims + 1, dims + 1)))[0]
    none = np.zeros(0, np.int64)
    index = Index(dims, kind, longest, rotation, np.zeros((0, 0), np.float32), 1, none, 0, none, none)
    points = index.rotated(sample)
    n_lists = max(1, min(round(distinct**0.5), SAMPLE_ROWS // 16, len(points)))
    centres = points[rng.choice(len(points), n_lists, replace=False)]
    for _ in range(10):
        near = Index(*_fields(index, centres=centres)).lists(points)
        sums = np.zeros((n_lists, points.shape[1]))
        np.add.at(sums, near, points)
        held = np.bincount(near, minlength=n_lists)
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres).astype(np.float32)
    index = Index(*_fields(index, centres=centres))
    near = index.lists(points)
    # Of each sampled query's neighbours in the sample: how near their list is.
    asked = np.arange(min(len(points), 1024))
    queries = index.rotated(sample[asked], query=True)
    likeness = queries @ points.T
    likeness[asked, asked] = -np.inf
    best = np.argsort(-likeness, axis=1)[:, : max(1, min(k, len(points) - 1))]
    order = np.argsort(-index.closeness(queries), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n_lists)[None, :].repeat(len(asked), 0), axis=1)
    reached = np.cumsum(np.bincount(np.take_along_axis(rank, near[best], axis=1).ravel(), minlength=n_lists))
    probes = int(np.searchsorted(reached, TARGET * reached[-1])) + 1
    # Lists in order share parts of about a chunk; a list of many chunks is dealt to several parts.
    sampled = np.bincount(near, minlength=n_lists)
    expected = sampled / len(points) * distinct
    target = 0.8 * max(1, CHUNK_NUMBERS // (dims + 1))
    n_parts = np.maximum(np.ceil(expected / target).astype(np.int64), 1)
    first_part, part, filled = np.zeros(n_lists, np.int64), 0, 0.0
    for at in range(n_lists):
        if filled and filled + expected[at] > target:
            part, filled = part + 1, 0.0
        first_part[at] = part
        filled += expected[at]
        if n_parts[at] > 1:
            part, filled = part + int(n_parts[at]), 0.0
    least = min(k + 1, len(points))
    return Index(
        *_fields(index, probes=probes, sampled=sampled, least=least, first_part=first_part, n_parts=n_parts)
    )


def _fields(index: Index, **changed) -> list:
    return [changed.get(name, getattr(index, name)) for name in Index.__dataclass_fields__]


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    kinds["array<int>"] = pa.list_(pa.int32())
    names, types = zip(*(c.split(" ") for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def _packed_index(rows: DataFrame, index: Index) -> DataFrame:
    """Chunks of the distinct vectors, those of a list side by side."""
    dims, size = index.dims, max(1, CHUNK_NUMBERS // (index.dims + 1))
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            near = model.lists(model.rotated(_matrix(batch.column("vec"), dims).astype(float)))
            turn = batch.column("k1").to_numpy().astype(np.uint64) % model.n_parts[near].astype(np.uint64)
            part = model.first_part[near] + turn.astype(np.int64)
            added = [pa.array(near.astype(np.int32)), pa.array(part)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "list", "part"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, place, count = shared.value, 0, 0
        partition = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            nonlocal place, count
            whole = pa.Table.from_batches(held).combine_chunks()
            lists = whole["list"].to_numpy()
            order = np.argsort(lists, kind="stable")
            lists = lists[order]
            vectors = _matrix(whole["vec"].combine_chunks(), dims)[order]
            keys = np.column_stack([whole["k1"].to_numpy(), whole["k2"].to_numpy()])[order]
            flags = whole["query"].to_numpy()[order]
            rotated = np.ascontiguousarray(model.rotated(vectors.astype(float)).T)
            name = (partition << 32) | (place << 8)
            place, count = place + 1, 0
            held.clear()
            parts = (keys, lists, flags, vectors, rotated)
            row = [[name], [len(lists)], [np.unique(lists).tolist()], *([p.tobytes()] for p in parts)]
            return _batch(row, INDEX)

        for whole in batches:
            start = 0
            while start < whole.num_rows:
                batch = whole.slice(start, size - count)
                start += batch.num_rows
                count += batch.num_rows
                held.append(batch)
                if count == size:
                    yield chunk()
        if count:
            yield chunk()

    distinct = rows.groupBy("vec").agg(F.max("query").alias("query"))
    distinct = distinct.withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(1), "vec")})
    added = [StructField("list", IntegerType()), StructField("part", LongType())]
    schema = StructType([*distinct.schema.fields, *added])
    dealt = distinct.mapInArrow(assign, schema).repartition("part").sortWithinPartitions("part", "list")
    return staged(dealt.mapInArrow(pack, INDEX), "neighbour-index")


@dataclass
class _Chunk:
    """A chunk of the index as arrays."""

    keys: np.ndarray
    lists: np.ndarray
    vectors: np.ndarray
    rotated: np.ndarray

    @staticmethod
    def of(row: dict, index: Index) -> _Chunk:
        n = row["n"]
        return _Chunk(
            np.frombuffer(row["keys"], np.int64).reshape(n, 2),
            np.frombuffer(row["lists"], np.int32),
            np.frombuffer(row["vectors"], index.kind).reshape(n, index.dims),
            np.frombuffer(row["rotated"], np.float32).reshape(index.dims + 1, n),
        )

    def segments(self) -> Iterator[tuple[int, int, int]]:
        """list, start, stop of each list in the chunk, in steps."""
        starts = np.flatnonzero(np.diff(self.lists, prepend=-1))
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(self.lists)]):
            for step in range(start, stop, STEP_ROWS):
                yield int(self.lists[start]), step, min(step + STEP_ROWS, stop)


def adaptive_scan(queries: np.ndarray, block: np.ndarray, beat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that pass every test, with their products.

    ``queries`` are rows, ``block`` holds a row for each coordinate.  While many pairs are
    left, a block of coordinates is multiplied for all of them; after that only for the pairs that are left.
    """
    dims = len(block)
    limit = 2.0 - 2.0 * (beat - SLACK)
    product = np.zeros((len(queries), block.shape[1]), np.float32)
    q_square, c_square = np.zeros(len(queries), np.float32), np.zeros(block.shape[1], np.float32)
    pairs = None
    for start in range(0, dims, BLOCK_COLUMNS):
        stop = min(start + BLOCK_COLUMNS, dims)
        q, c = queries[:, start:stop], block[start:stop]
        q_square = q_square + (q * q).sum(1)
        c_square = c_square + (c * c).sum(0)
        width = 1.0 if stop == dims else stop / dims * (1 + EPSILON / np.sqrt(stop)) ** 2
        allowed = (np.minimum(limit * width, 8.0) - q_square).astype(np.float32)
        if pairs is None:
            product += q @ c
            left = c_square[None, :] - 2 * product <= allowed[:, None]
            if np.count_nonzero(left) * 8 < left.size or stop == dims:
                at_q, at_c = np.nonzero(left)
                pairs = at_q, at_c, product[at_q, at_c]
        else:
            at_q, at_c, sofar = pairs
            sofar = sofar + np.einsum("ij,ij->i", q[at_q], c.T[at_c])
            left = c_square[at_c] - 2 * sofar <= allowed[at_q]
            pairs = at_q[left], at_c[left], sofar[left]
    return pairs


def _kept(at_q: np.ndarray, at_c: np.ndarray, value: np.ndarray, k: int, slack: float):
    """The k largest values of each query and all within ``slack`` of the last; places, and each query's k-th value."""
    order = np.lexsort((-value, at_q))
    at_q, at_c, value = at_q[order], at_c[order], value[order]
    starts = np.flatnonzero(np.diff(at_q, prepend=-1))
    sizes = np.diff(starts, append=len(at_q))
    full = sizes >= k
    last = np.full(len(starts), -np.inf)
    last[full] = value[starts[full] + k - 1]
    keep = value >= np.repeat(last, sizes) - slack
    return at_q[keep], at_c[keep], value[keep], at_q[starts[full]], last[full]


def search_chunk(queries: np.ndarray, probes: np.ndarray, beat: np.ndarray, chunk: _Chunk, k: int):
    """Places of queries and candidates that may be among the k best of the chunk; the scores to beat after it."""
    beat = beat.copy()
    pool = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
    for held, start, stop in chunk.segments():
        asks = np.flatnonzero(probes[:, held])
        if not len(asks):
            continue
        at_q, at_c, value = adaptive_scan(queries[asks], chunk.rotated[:, start:stop], beat[asks])
        if len(at_q):
            found = (asks[at_q], at_c + start, value)
            *pool, full, last = _kept(*(np.concatenate(p) for p in zip(pool, found)), k, 2 * SLACK)
            beat[full] = np.maximum(beat[full], last - SLACK)
    return pool[0], pool[1], beat


def _seeded_queries(chunks: DataFrame, index: Index, k: int) -> DataFrame:
    """Chunks of queries with their probed lists and the score that k vectors of their own list reach."""
    shared = chunks.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for place in range(batch.num_rows):
                (row,) = batch.slice(place, 1).to_pylist()
                chunk = _Chunk.of(row, model)
                flagged = np.flatnonzero(np.frombuffer(row["flags"], bool))
                for slot, start in enumerate(range(0, len(flagged), QUERY_ROWS)):
                    at = flagged[start : start + QUERY_ROWS]
                    rotated = model.rotated(chunk.vectors[at].astype(float), query=True)
                    own = np.zeros((len(at), len(model.centres)), bool)
                    own[np.arange(len(at)), chunk.lists[at]] = True
                    _, _, beat = search_chunk(rotated, own, np.full(len(at), -np.inf), chunk, k)
                    probes = model.probed(rotated)
                    parts = (chunk.keys[at], chunk.vectors[at], beat, np.packbits(probes, axis=1))
                    lists = np.flatnonzero(probes.any(0)).tolist()
                    yield _batch([[row["chunk"] | slot], [len(at)], [lists], *([p.tobytes()] for p in parts)], QUERIES)

    wanted = chunks.select("chunk", "n", "keys", "lists", "flags", "vectors", "rotated")
    return staged(wanted.mapInArrow(run, QUERIES), "neighbour-queries")


def _search(tiles: DataFrame, index: Index, k: int) -> DataFrame:
    shared = tiles.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        beats: OrderedDict[int, np.ndarray] = OrderedDict()
        for batch in batches:
            for place in range(batch.num_rows):
                (row,) = batch.slice(place, 1).to_pylist()
                chunk, n = _Chunk.of(row, model), row["q_n"]
                vectors = np.frombuffer(row["q_vectors"], model.kind).reshape(n, model.dims)
                keys = np.frombuffer(row["q_keys"], np.int64).reshape(n, 2)
                bits = np.frombuffer(row["q_probes"], np.uint8).reshape(n, -1)
                probes = np.unpackbits(bits, axis=1, count=len(model.centres)).astype(bool)
                beat = beats.pop(row["q"], None)
                beat = np.frombuffer(row["q_beat"], float) if beat is None else beat
                rotated = model.rotated(vectors.astype(float), query=True)
                at_q, at_c, beat = search_chunk(rotated, probes, beat, chunk, k)
                beats[row["q"]] = beat
                if len(beats) > REMEMBERED:
                    beats.popitem(last=False)
                score = np.zeros(len(at_q))
                for j in range(model.dims):
                    score += vectors[at_q, j].astype(float) * chunk.vectors[at_c, j].astype(float)
                at_q, at_c, score, _, _ = _kept(at_q, at_c, score, k, 0.0)
                yield _batch([*keys[at_q].T, *chunk.keys[at_c].T, score], FOUND)

    return tiles.mapInArrow(run, FOUND)


def nearest_neighbours(
    vectors: DataFrame,
    query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k found candidates with the largest inner product for each query: query_id, rank, vec_id, score.

    Queries are the rows for which ``query`` holds, candidates all rows but the query's own.
    Scores are inner products of the original vectors in double precision, added up in the order of the dimensions;
    a pair whose products leave that range has none and is left out.
    The candidates are those of the probed lists that pass the tests; at least TARGET of the true neighbours is aimed
    at.  All rows are indexed; copies of a vector are searched once.  Ties go to the smaller id.  The probed lists hold
    more than k vectors, or else the whole table, so that only a query with fewer candidates than k has fewer rows.
    Null ids and vectors that are null, zero, empty or hold a null, NaN or infinite component take no part;
    shorter vectors end in zeros.  Rows with equal ids are different rows.  An empty table, or one without queries, gives no rows.
    """
    most = k + 1  # a query's own row is found too
    rows = comparable_vectors(vectors, query, id_column, vector_column)
    members = staged(rows.select(F.monotonically_increasing_id().alias("uid"), "id", "query", "k1", "k2"), "vector-ids")
    distinct = members.agg(F.approx_count_distinct("k1", 0.02)).first()[0]
    index = fit_index(rows, distinct, k)
    if index is None:
        return members.filter("false").select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        )
    chunks = _packed_index(rows, index)
    asked = _seeded_queries(chunks, index, most)
    held = chunks.select("chunk", F.explode("held").alias("list"))
    pairs = asked.select("q", F.explode("probed").alias("list")).join(held, "list").select("q", "chunk").distinct()
    # Every chunk is a key of its own, so that even a list of many copies is spread.
    parts = max(1, min(chunks.count(), 1 << 14))
    met = pairs.join(asked.hint("merge"), "q").drop("probed").repartition(parts, "chunk")
    against = chunks.select("chunk", "n", "keys", "lists", "vectors", "rotated").repartition(parts, "chunk")
    found = _search(met.hint("merge").join(against, "chunk"), index, most)
    best = Window.partitionBy("q1", "q2").orderBy(F.col("score").desc())
    nearest = found.withColumn("place", F.rank().over(best)).filter(F.col("place") <= most).drop("place")
    # Of a vector's copies only the smallest ids can be among the best.
    first = Window.partitionBy("k1", "k2").orderBy("id", "uid")
    ids = members.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= most)
    ids = ids.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("id").alias("vec_id"), "uid")
    order = [F.col("score").desc(), "vec_id", "uid"]
    spread = nearest.join(ids, ["c1", "c2"]).withColumn(
        "place", F.row_number().over(Window.partitionBy("q1", "q2").orderBy(*order))
    )
    asking = members.filter("query").select(
        F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("id").alias("query_id"), F.col("uid").alias("q_uid")
    )
    answers = asking.join(spread.filter(F.col("place") <= most).drop("place"), ["q1", "q2"]).filter("uid <> q_uid")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("q_uid").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
