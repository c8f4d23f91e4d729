"""Whitening of embeddings by the principal components of their distinct integer vectors.

Sums and covariance are added up over the tasks, dims x dims numbers each.  The driver splits the
covariance into components by polar decompositions (``spectral``) and broadcasts a
matrix of dims x components; every row is then whitened where it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from rookery.llm.spectral import leading_components
from rookery.llm.tables import quoted, staged

#: Largest number whose square and sums fit 64 bits in a deviation.
_EXACT = 9.2e18


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors, their sums per dimension (exact), components as columns, eigenvalues, shares, check."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    explained: tuple[float | None, ...]
    identity_error: float | None


def valid_vectors(vectors: DataFrame, vector_column: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    vector = F.col(quoted(vector_column)).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(F.coalesce(vector.isNotNull() & finite, F.lit(False)))


def integer_vector(vector_column: str, scale: float) -> Column:
    """floor(scale x component) of each component."""
    vector = F.col(quoted(vector_column)).cast("array<double>")
    return F.transform(vector, lambda x: F.floor(x * scale).cast("long"))


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(lists), dims), np.int64)
    at = np.repeat(np.arange(len(lists)), sizes)
    found[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return found


def fit_list(vectors: DataFrame, dims: int, scale: float, vector_column: str) -> DataFrame:
    """Each distinct integer vector once, in one column ``x`` of ``dims`` numbers.

    Copies collapse in the map tasks; an equal share of distinct vectors reaches every reduce task.
    """
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))
    rows = valid_vectors(vectors, vector_column).select(integer_vector(vector_column, scale).alias("x"))
    return staged(rows.select(F.concat("x", padding).alias("x")).distinct(), "whitening-fit")


def _totals(rows: DataFrame, dims: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and their exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            total = [len(x), *(int(v) for v in x.sum(0))]
            if len(x) * float(np.abs(x).max(initial=0)) > _EXACT:
                total = [len(x), *(sum(c) for c in x.T.tolist())]
            exact = pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), exact], ["at", "x"])

    kinds = StructType([StructField("at", LongType()), StructField("x", DecimalType(38, 0))])
    found = {r.at: int(r.x) for r in rows.mapInArrow(run, kinds).groupBy("at").agg(F.sum("x").alias("x")).collect()}
    return found.get(0, 0), tuple(found.get(i + 1, 0) for i in range(dims))


def _added(rows: DataFrame, width: int, function: Callable[[pa.ListArray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``function``'s ``width`` numbers per batch; one row for each number leaves a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += function(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["at", "x"])

    kinds = StructType([StructField("at", LongType()), StructField("x", DoubleType())])
    found = np.zeros(width)
    for at, x in rows.mapInArrow(run, kinds).groupBy("at").agg(F.sum("x")).collect():
        found[at] = x
    return found


def fit_whitening(
    vectors: DataFrame, k: int = 4, scale: float = 256.0, vector_column: str = "embedding"
) -> Whitening:
    """Components of the distinct integer vectors' covariance; dims x dims numbers come to the driver."""
    valid = valid_vectors(vectors, vector_column)
    dims = valid.agg(F.max(F.size(quoted(vector_column)))).first()[0] or 0
    rows = fit_list(vectors, dims, scale, vector_column)
    n, sums = _totals(rows, dims)
    if not n or not dims:
        return Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), (), None)
    mean = np.array([s / n for s in sums])

    def products(lists: pa.ListArray) -> np.ndarray:
        centred = _matrix(lists, dims) - mean
        return (centred.T @ centred).ravel()

    covariance = _added(rows, dims * dims, products).reshape(dims, dims) / n
    values, axes = leading_components(covariance, k)
    trace = np.trace(covariance)
    # Below this an eigenvalue is rounding of a dimension without variance.
    spread = values > 64 * dims * np.finfo(float).eps * max(trace, 0.0)
    scaled = axes[:, spread] / np.sqrt(values[spread])
    width = scaled.shape[1]

    def whitened_products(lists: pa.ListArray) -> np.ndarray:
        white = (_matrix(lists, dims) - mean) @ scaled
        return np.concatenate([(white.T @ white).ravel(), white.sum(0)])

    error = None
    if width:
        added = _added(rows, width * width + width, whitened_products) / n
        centre = added[width * width :]
        product = added[: width * width].reshape(width, width) - np.outer(centre, centre)
        error = float(np.abs(product - np.eye(width)).max())
    shares = tuple(float(v / trace) if trace > 0 else None for v in np.where(spread, values, 0.0))
    return Whitening(n, sums, axes, np.where(spread, values, 0.0), shares, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - sum) squared, exact; None where it needs more than 64 bits."""
    rough = ((n * x.astype(float) - np.array(sums, float)) ** 2).sum(1)
    found: list[int | None] = [None] * len(x)
    small = rough < _EXACT
    # A single product may be out of range though the difference is not: then plain integers.
    if small.any() and n * np.abs(x[small]).max(initial=0).astype(float) < _EXACT and max(map(abs, sums), default=0) < _EXACT:
        exact = ((n * x[small] - np.array(sums, np.int64)) ** 2).sum(1)
        for at, value in zip(np.flatnonzero(small).tolist(), exact.tolist()):
            found[at] = value
    else:
        for at in np.flatnonzero(small).tolist():
            found[at] = sum((n * int(v) - s) ** 2 for v, s in zip(x[at], sums))
    return found


def whiten(
    vectors: DataFrame,
    k: int = 4,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Each row's first k whitened coordinates: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors become integers x = floor(scale x component).  The covariance is that of the n distinct
    x; components are its unit eigenvectors by falling eigenvalue e.  ``whitened`` is the
    centred x on the component over the root of e, ``explained`` e's share of the trace,
    ``deviation`` the squared length of n x - sum, exact, and null where it needs more than 64 bits.
    ``identity_error`` is the largest entry by which the covariance of the whitened distinct vectors differs from the identity.

    Rows whose vector is null or holds a null, NaN or infinite component are dropped; all others stay, with null or
    repeated ids too.  Shorter vectors end in zeros.  With fewer dimensions than k there are
    fewer components.  A component without variance (a single distinct vector, dependent
    dimensions) has null ``whitened`` and ``explained`` 0, or null if nothing varies; ``identity_error`` leaves it out and is
    null if no component varies.  An empty table, or vectors without components, give no rows.
    """
    model = fit_whitening(vectors, k, scale, vector_column)
    dims, width = model.axes.shape
    mean = np.array([s / model.n for s in model.sums]) if model.n else np.zeros(dims)
    roots = np.sqrt(np.where(model.values > 0, model.values, np.nan))
    shared = vectors.sparkSession.sparkContext.broadcast((model, mean, model.axes / roots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, centre, scaled = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            rows = len(x)
            white = (x - centre) @ scaled
            where = np.repeat(np.arange(rows), width)
            whole = deviations(x, fitted.n, fitted.sums)
            columns = [
                batch.column(0).take(pa.array(where)),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * width, fitted.n)),
                pa.array(whole, pa.int64()).take(pa.array(where)),
                pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                pa.array(list(fitted.explained) * rows, pa.float64()),
                pa.array([fitted.identity_error] * (rows * width), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = valid_vectors(vectors, vector_column).select(
        F.col(quoted(id_column)).alias("vec_id"), integer_vector(vector_column, scale).alias("x")
    )
    kinds = [
        StructField("vec_id", rows.schema["vec_id"].dataType),
        StructField("component", IntegerType()),
        StructField("n", LongType()),
        StructField("deviation", LongType()),
        StructField("whitened", DoubleType()),
        StructField("explained", DoubleType()),
        StructField("identity_error", DoubleType()),
    ]
    names = [kind.name for kind in kinds]
    return rows.mapInArrow(run, StructType(kinds))
