"""Embedding whitening from exact integer cross-products of bit planes.

Entries become integers ``x = floor(scale * c)``.  The covariance is that of
the distinct integer vectors.  Their cross-products are counted bit by bit:
each dimension is shifted to start at zero, and each bit of it across many
rows is packed into words, a plane.  The AND of two planes has a one for each
row with both bits, so popcounts of all pairs of planes, weighted by the bits'
places, are exact cross-products.  Tasks add up popcounts by pair of
dimensions and weight; a shuffle adds up the tasks' counts, and what reaches
the driver is bounded by the dimensions, not by the rows.  There the products
are centred as integers (``n * sum(xy) - sum(x) * sum(y)``, which the shift
does not change), divided once, and given to ``eigh``.

A row is then projected: its deviation ``n * x - sums`` is an integer, divided
by ``n`` once, times a unit eigenvector over the root of its eigenvalue, each
summed in one fixed order, so equal rows get equal values.

Defined results: vectors that are null, empty or hold null or non-finite
entries are dropped, as are those with an entry whose integer lies beyond
2^62 and those of another length than the commonest one (of equally common
ones, the longest); repeated rows count once in the covariance and are all
returned; an id of null stays; a component without variance (all vectors
equal, or more components than the data have directions) has a ``whitened`` of
null and takes no part in the error; ``deviation`` is null where it passes
2^63; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, batches_of, ddl, write_shared

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 16_384          # rows packed into planes at a time
MOST = 1 << 62               # integers beyond are not kept

RESULT = ddl("vec_id:long component:int n:long deviation:long whitened:double explained:double identity_error:double")


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part, of any length."""
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c"))

    def fits(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v * F.lit(float(scale))) < F.lit(float(MOST)))

    kept = source.where(F.coalesce((F.size("c") > 0) & F.forall("c", fits), F.lit(False)))
    return kept.select("vec_id", F.transform("c", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# --------------------------------------------------------------------------- bit planes


def planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The bit planes of shifted rows, dimension by dimension, lowest bit first: one packed row of words for each."""
    words = -(-len(y) // 64)
    out = np.zeros((int(bits.sum()), words * 8), dtype=np.uint8)
    at = 0
    for j, width in enumerate(bits.tolist()):
        column = np.ascontiguousarray(y[:, j])
        for b in range(width):
            packed = np.packbits(((column >> np.uint64(b)) & np.uint64(1)).astype(bool), bitorder="little")
            out[at, :len(packed)] = packed
            at += 1
    return out.view(np.uint64)


class PlaneCounts:
    """Popcounts of planes and of pairs of planes, added up by (pair of) dimension and weight."""

    def __init__(self, low: np.ndarray, bits: np.ndarray):
        self.low, self.bits = low, bits
        self.dim = np.repeat(np.arange(len(bits)), bits)
        self.bit = np.concatenate([np.arange(w) for w in bits.tolist()] or [np.zeros(0, np.int64)]).astype(np.int64)
        d, self.weights = len(bits), 2 * int(bits.max(initial=1))
        self.pairs = np.zeros((d, d, self.weights), dtype=np.int64)
        self.singles = np.zeros((d, self.weights), dtype=np.int64)

    def add(self, x: np.ndarray) -> None:
        packed = planes((x - self.low).astype(np.uint64), self.bits)
        for p in range(len(packed)):
            j, a = int(self.dim[p]), int(self.bit[p])
            first = p - a                                    # all planes of dimensions from j on
            both = np.bitwise_count(packed[first:] & packed[p]).sum(axis=1, dtype=np.int64)
            self.pairs[j, self.dim[first:], a + self.bit[first:]] += both
            self.singles[j, a] += both[a]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Non-zero counts as (first dimension, second dimension or -1, weight's exponent, count)."""
        j, k, s = np.nonzero(self.pairs)
        j1, s1 = np.nonzero(self.singles)
        return (np.concatenate([j, j1]), np.concatenate([k, np.full(len(j1), -1)]), np.concatenate([s, s1]),
                np.concatenate([self.pairs[j, k, s], self.singles[j1, s1]]))


# --------------------------------------------------------------------------- model


@dataclass
class Whitening:
    """Means and components of a fit list of ``n`` integer vectors."""

    n: int
    sums: list[int]
    values: np.ndarray           # eigenvalues, falling
    vectors: np.ndarray          # unit eigenvectors as rows
    trace: float
    usable: np.ndarray           # components with variance

    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace > 0 else None for e in self.values]


def centred(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance with divisor ``n``: integers up to one division."""
    d = len(sums)
    out = np.zeros((d, d))
    for j in range(d):
        for k in range(j, d):
            out[j, k] = out[k, j] = (n * products[j, k] - sums[j] * sums[k]) / (n * n)
    return out


def solve(n: int, sums: list[int], covariance: np.ndarray, components: int) -> Whitening:
    # A power of two keeps every digit and lets eigh work near one.
    top = float(np.abs(covariance).max(initial=0.0))
    unit = 2.0 ** math.frexp(top)[1] if top > 0 else 1.0
    values, vectors = np.linalg.eigh(covariance / unit)
    values, vectors = values[::-1] * unit, vectors[:, ::-1].T
    signs = np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1) < 0, -1.0, 1.0)
    floor = max(float(values[0]), 0.0) * len(sums) * 2 * np.finfo(float).eps
    least = min(components, len(sums))
    return Whitening(n, sums, values[:least], np.ascontiguousarray((vectors * signs)[:least]), float(np.trace(covariance)), values[:least] > floor)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on ``distinct(x)``, equally long integer vectors, each once; None if there is none."""
    ranged = distinct.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("at").collect()
    if not ranged:
        return None
    n = ranged[0]["n"]
    low = np.array([r["low"] for r in ranged], dtype=np.int64)
    bits = np.array([max(1, (r["high"] - r["low"]).bit_length()) for r in ranged], dtype=np.int64)
    counted = ddl("j:int k:int s:int c:long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PlaneCounts(low, bits)
        for batch in batches:
            x = matrix(batch.column(0))
            for at in range(0, len(x), BLOCK_ROWS):
                counts.add(x[at:at + BLOCK_ROWS])
        schema = arrow_schema(counted)
        j, k, s, c = counts.rows()
        yield from batches_of(schema, {"j": pa.array(j, pa.int32()), "k": pa.array(k, pa.int32()), "s": pa.array(s, pa.int32()), "c": pa.array(c)})

    summed = distinct.select("x").mapInArrow(count, counted).groupBy("j", "k", "s").agg(F.sum("c").alias("c")).collect()
    products: dict[tuple[int, int], int] = defaultdict(int)
    shifted = [0] * len(low)
    for j, k, s, c in summed:                                # at most dimensions squared times the weights
        if k < 0:
            shifted[j] += c << s
        else:
            products[j, k] += c << s
    covariance = centred(n, shifted, products)
    sums = [y + n * int(m) for y, m in zip(shifted, low)]
    return solve(n, sums, covariance, components)


def projected(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """``whitened`` (rows by components, NaN without variance) and the exact deviations of integer rows."""
    largest = max([int(np.abs(x).max(initial=0)) * model.n, *map(abs, model.sums)])
    if largest < 1 << 61:
        moved = x * np.int64(model.n) - np.array(model.sums, dtype=np.int64)
        centre = moved.astype(np.float64) / model.n
        if largest < 1 << 31 and 4 * largest * largest * x.shape[1] < 1 << 63:
            deviation = (moved * moved).sum(axis=1).tolist()
        else:
            deviation = [sum(v * v for v in row) for row in moved.tolist()]
    else:
        exact = [[v * model.n - s for v, s in zip(row, model.sums)] for row in x.tolist()]
        centre = np.array([[v / model.n for v in row] for row in exact]).reshape(x.shape)
        deviation = [sum(v * v for v in row) for row in exact]
    out = np.full((len(x), len(model.values)), np.nan)
    for c in np.flatnonzero(model.usable).tolist():
        out[:, c] = (centre * model.vectors[c]).sum(axis=1) / math.sqrt(model.values[c])
    return out, deviation


def identity_error(model: Whitening, distinct: DataFrame) -> float | None:
    """Largest entry, in size, of the fit list's whitened covariance minus the identity."""
    c = len(model.values)
    partial = ddl("at:int v:double")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(c), np.zeros((c, c))
        for batch in batches:
            w, _ = projected(model, matrix(batch.column(0)))
            sums, products = sums + w.sum(axis=0), products + w.T @ w
        values = np.concatenate([sums, products.ravel()])
        yield from batches_of(arrow_schema(partial), {"at": pa.array(np.arange(len(values)), pa.int32()), "v": pa.array(values)})

    totals = np.zeros(c + c * c)
    for at, v in distinct.select("x").mapInArrow(add, partial).groupBy("at").agg(F.sum("v")).collect():
        totals[at] = v
    sums, products = totals[:c], totals[c:]
    keep = np.flatnonzero(model.usable)
    if not len(keep):
        return None
    mean = sums[keep] / model.n
    covariance = products.reshape(c, c)[np.ix_(keep, keep)] / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(keep))).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows ``(vec_id, component, n, deviation, whitened, explained, identity_error)``, components from 1."""
    spark = vectors.sparkSession
    prepared = write_shared(integer_vectors(vectors, id_col, vector_col, scale), "integer-vectors")
    widths = prepared.groupBy(F.size("x").alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc()).first()
    if widths is None:
        return spark.createDataFrame([], RESULT)
    kept = prepared.where(F.size("x") == widths["width"])
    distinct = write_shared(kept.select("x").distinct(), "fit-list")
    model = fit(distinct, components)
    error, explained = identity_error(model, distinct), model.explained()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(RESULT)
        for batch in batches:
            if not batch.num_rows:
                continue
            w, deviation = projected(model, matrix(batch.column(1)))
            exact = pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64())
            many = w.shape[1]
            at = pa.array(np.repeat(np.arange(len(w)), many))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, many + 1), len(w)), pa.int32()),
                pa.array(np.full(len(w) * many, model.n), pa.int64()), exact.take(at), pa.array(w.ravel(), from_pandas=True),
                pa.array(explained * len(w), pa.float64()), pa.array([error] * len(w) * many, pa.float64())], schema=schema)

    return kept.mapInArrow(rows, RESULT)
