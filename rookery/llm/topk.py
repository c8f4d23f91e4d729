"""Exact top-k inner products over norm-sorted blocks.

Vectors of integers are processed by descending length, in blocks.  A query
first meets the longest block, which gives it a score to beat; blocks too short to reach
it (|q| |x| bounds q.x) are never sent to it.  Within a block both sides are
rotated to the principal axes, so that a few leading coordinates carry most of
a product: their partial sum plus the product of the residual lengths bounds
the rest (Cauchy-Schwarz), and only what can still reach the score is multiplied out, in integers.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.tables import map_batches, quoted, staged

#: Numbers (vectors x coordinates) of a candidate block, 2 MB, and of a query block.
BLOCK_NUMBERS = 1 << 18
QUERY_NUMBERS = 1 << 16
#: Candidates between two updates of the scores to beat.
STEP_ROWS = 512
#: Block lengths that come to the driver to tell which blocks a query needs.
LENGTH_MARKS = 256
#: Query blocks whose scores to beat a task remembers, 8 KB each.
REMEMBERED = 256
#: Share of the rotated coordinates in the partial sum.
LEADING = 0.25

BLOCKS = "part int, place long, length double, n int, dims int, data binary"
RESULT = "query_uid long, query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, query: Column, scale: float, id_column: str, vector_column: str) -> DataFrame:
    """uid, id, query, values (floor of scale times each component), length; rows that take no part left out."""
    vector = F.col(quoted(vector_column)).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.filter(F.col(quoted(id_column)).isNotNull() & F.col(quoted(vector_column)).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(quoted(id_column)).cast("long").alias("id"),
        F.coalesce(query, F.lit(False)).alias("query"),
        F.transform(vector, lambda x: F.floor(x * scale).cast("long")).alias("values"),
    )
    squares = F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return staged(rows.withColumn("length", F.sqrt(squares)), "integer-vectors")


def _matrix(lists: pa.ListArray | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    found = np.zeros((len(lists), dims), np.int64)
    at = np.repeat(np.arange(len(lists)), sizes)
    found[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return found


def _packed(rows: DataFrame, dims: int, size: int, label: str) -> DataFrame:
    """Blocks of ``size`` vectors by descending length, numbered: block, length (the largest), n, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal place
            uids, ids, lengths, values = (np.concatenate(c) for c in zip(*held))
            data = uids.tobytes() + ids.tobytes() + values.tobytes()
            row = ([part], [place], [float(lengths.max())], [len(ids)], [dims], [data])
            place += 1
            held.clear()
            kinds = (pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.binary())
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)

        count = 0
        for whole in batches:
            start = 0
            while start < whole.num_rows:
                batch = whole.slice(start, size - count)
                start += batch.num_rows
                count += batch.num_rows
                uid, key, length = (batch.column(k).to_numpy() for k in ("uid", "id", "length"))
                held.append((uid, key, length, _matrix(batch.column("values"), dims)))
                if count == size:
                    yield block()
                    count = 0
        if count:
            yield block()

    longest = F.col("length").desc()
    ordered = rows.select("uid", "id", "length", "values").repartitionByRange(longest, F.xxhash64("uid"))
    blocks = staged(ordered.sortWithinPartitions(longest).mapInArrow(run, BLOCKS), label)
    counts = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("blocks"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("part").alias("_part"), F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("base"))
    numbered = blocks.join(bases, F.col("part") == F.col("_part"))
    return numbered.select((F.col("base") + F.col("place")).alias("block"), "length", "n", "data")


def _unpacked(n: int, dims: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.int64)
    return raw[:n], raw[n : 2 * n], raw[2 * n :].reshape(n, dims)


def principal_axes(rows: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, by descending singular value.

    Tasks add up products of coordinates; dims x dims numbers leave each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            values = _matrix(batch.column(0), dims).astype(float)
            total += values.T @ values
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["at", "x"])

    sums = rows.select("values").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x")).collect()
    gram = np.zeros(dims * dims)
    for at, x in sums:
        gram[at] = x
    _, axes = np.linalg.eigh(gram.reshape(dims, dims))
    return np.ascontiguousarray(axes[:, ::-1])


def block_top(
    queries: tuple[np.ndarray, ...], candidates: tuple[np.ndarray, ...], axes: np.ndarray, k: int, beat: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and candidates with their scores, the k best of each query that reach ``beat``; new beat."""
    q_uid, _, q = queries
    c_uid, c_id, c = candidates
    lead = max(1, int(q.shape[1] * LEADING))
    q_axes, c_axes = q @ axes, c @ axes
    q_rest = np.sqrt((q_axes[:, lead:] ** 2).sum(1))
    c_rest = np.sqrt((c_axes[:, lead:] ** 2).sum(1))
    q_length, c_length = np.sqrt((q_axes**2).sum(1)), np.sqrt((c_axes**2).sum(1))
    own = {uid: place for place, uid in enumerate(c_uid.tolist())}
    own_at = np.array([own.get(uid, -1) for uid in q_uid.tolist()])
    best_q, best_c, best_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    beat = beat.copy()
    for start in range(0, len(c), STEP_ROWS):
        stop = min(start + STEP_ROWS, len(c))
        # Rounding of the rotated products stays far below this.
        slack = 1e-9 * np.outer(q_length, c_length[start:stop]) + 1e-6
        bound = q_axes[:, :lead] @ c_axes[start:stop, :lead].T + np.outer(q_rest, c_rest[start:stop]) + slack
        at_q, at_c = np.nonzero(bound >= beat[:, None])
        at_c += start
        other = own_at[at_q] != at_c
        at_q, at_c = at_q[other], at_c[other]
        score = np.concatenate(
            [np.einsum("ij,ij->i", q[at_q[i : i + 65536]], c[at_c[i : i + 65536]]) for i in range(0, len(at_q), 65536)]
            or [np.zeros(0, np.int64)]
        )
        reach = score >= beat[at_q]
        best_q = np.concatenate([best_q, at_q[reach]])
        best_c = np.concatenate([best_c, at_c[reach]])
        best_s = np.concatenate([best_s, score[reach]])
        order = np.lexsort((c_id[best_c], -best_s, best_q))
        best_q, best_c, best_s = best_q[order], best_c[order], best_s[order]
        place = np.arange(len(best_q)) - np.searchsorted(best_q, best_q)
        best_q, best_c, best_s = best_q[place < k], best_c[place < k], best_s[place < k]
        last = place[place < k] == k - 1
        beat[best_q[last]] = np.maximum(beat[best_q[last]], best_s[last])
    return best_q, best_c, best_s, beat


def search_blocks(batches: Iterable[pa.RecordBatch], dims: int, axes: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Results of query blocks against candidate blocks, one pair a row.

    The scores that a query block has reached are carried along to the candidate blocks that follow in the
    task, and queries too short to reach theirs with a block's length are not multiplied with it.
    """
    beats: OrderedDict[int, np.ndarray] = OrderedDict()
    names = [c.split()[0] for c in RESULT.split(", ")]
    for batch in batches:
        for place in range(batch.num_rows):
            (row,) = batch.slice(place, 1).to_pylist()
            queries = _unpacked(row["q_n"], dims, row["q_data"])
            beat = beats.pop(row["q_block"], None)
            beat = np.frombuffer(row["beat"], np.int64).copy() if beat is None else beat
            size = np.sqrt((queries[2].astype(float) ** 2).sum(1))
            reach = size * row["length"] * (1 + 1e-9) + 1e-6 >= beat
            if reach.any():
                asking = tuple(part[reach] for part in queries)
                candidates = _unpacked(row["n"], dims, row["data"])
                at_q, at_c, score, beat[reach] = block_top(asking, candidates, axes, k, beat[reach])
                columns = (asking[0][at_q], asking[1][at_q], candidates[1][at_c], score)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)
            beats[row["q_block"]] = beat
            if len(beats) > REMEMBERED:
                beats.popitem(last=False)


def top_inner_products(
    vectors: DataFrame,
    query: Column,
    k: int = 5,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k candidates with the largest inner product for each query: query_id, rank, vec_id, score.

    Queries are the rows for which ``query`` holds, candidates all rows but the
    query's own.  Components are floor(scale x component); scores are exact as
    long as they fit 64 bits.  Ties go to the smaller id; with fewer candidates than k there are fewer
    rows.  Null ids, null vectors and vectors with a null, NaN or infinite
    component take no part; shorter vectors end in zeros.  Rows with equal ids are different
    rows.  An empty table, or one without queries, gives no rows.
    """
    rows = integer_vectors(vectors, query, scale, id_column, vector_column)
    dims = rows.agg(F.max(F.size("values"))).first()[0] or 1
    axes = principal_axes(rows, dims)
    candidates = staged(_packed(rows, dims, max(1, BLOCK_NUMBERS // dims), "vector-blocks"), "candidate-blocks")
    queries = _packed(rows.filter("query"), dims, max(1, QUERY_NUMBERS // dims), "query-blocks").select(
        F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("data").alias("q_data")
    )
    n_blocks = candidates.count()
    stride = max(1, -(-n_blocks // LENGTH_MARKS))
    marks = candidates.filter(F.col("block") % stride == 0).select("block", "length").collect()
    lengths = np.array([r.length for r in sorted(marks)])
    # One block, of a fixed size, goes to every task with queries.
    longest = candidates.filter("block = 0").select("n", "data").first()

    def first(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        """Against the longest block: results so far, scores to beat, and how many blocks can matter."""
        for row in batch.to_pylist():
            q = _unpacked(row["q_n"], dims, row["q_data"])
            c = _unpacked(longest.n, dims, bytes(longest.data))
            at_q, at_c, score, beat = block_top(q, c, axes, k, np.full(row["q_n"], np.iinfo(np.int64).min))
            size = np.sqrt((q[2].astype(float) ** 2).sum(1))
            reach = size[:, None] * lengths[None, :] * (1 + 1e-9) + 1e-6 >= beat[:, None]
            needed = min(n_blocks, int(reach.any(0).sum()) * stride)
            columns = (
                [row["q_block"]], [row["q_n"]], [row["q_data"]], [beat.tobytes()], [needed],
                [q[0][at_q].tolist()], [q[1][at_q].tolist()], [c[1][at_c].tolist()], [score.tolist()],
            )
            longs = pa.list_(pa.int64())
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), longs, longs, longs, longs)
            names = ["q_block", "q_n", "q_data", "beat", "needed", "uids", "ids", "found", "scores"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names)

    seeded = staged(
        map_batches(
            queries,
            first,
            "q_block long, q_n int, q_data binary, beat binary, needed long, uids array<long>, ids array<long>, "
            "found array<long>, scores array<long>",
        ),
        "seeded-queries",
    )
    wanted = seeded.filter("needed > 1").select(
        "q_block", "q_n", "q_data", "beat", F.explode(F.sequence(F.lit(1), F.col("needed") - 1)).alias("_block")
    )
    # Both sides grow with the vectors: never broadcast.
    met = wanted.hint("merge").join(candidates, F.col("_block") == F.col("block"))
    met = met.select("q_block", "q_n", "q_data", "beat", "length", "n", "data")
    found = met.mapInArrow(lambda batches: search_blocks(batches, dims, axes, k), RESULT)
    start = seeded.select(F.explode(F.arrays_zip("uids", "ids", "found", "scores")).alias("z")).select(
        F.col("z.uids").alias("query_uid"),
        F.col("z.ids").alias("query_id"),
        F.col("z.found").alias("vec_id"),
        F.col("z.scores").alias("score"),
    )
    best = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), "vec_id")
    ranked = start.union(found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
