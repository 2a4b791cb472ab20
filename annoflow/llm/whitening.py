"""Whitening of embeddings, from a scatter matrix that is counted bit by bit.

Components become whole numbers. Each dimension, less its least value in a block of rows, is cut into
bit planes, and each plane of the block packed into words, one bit a row. The rows in which two planes both have
a bit are counted by AND and popcount, and those counts, weighted by the planes' powers of two, are the
cross-products of the block, exactly. Sums of blocks stay exact, so the matrix is centred in whole numbers and
rounded once, before its eigenvectors are sought.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from annoflow.session import temporary_tables, written

#: Whole numbers a unit.
SCALE = 256
#: Rows of a block: 8 KB a plane.
BLOCK_ROWS = 1 << 16
#: Sums go through Spark in two parts, of this many bits and of the rest: each fits a decimal for any number of rows.
LOW_BITS = 60
#: Share of the largest eigenvalue below which a direction counts as without variance.
FLAT = 1e-12
_LONG = (1 << 63) - 1


# --- bit planes -----------------------------------------------------------------


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Planes of rows of unsigned numbers (rows x dimensions): plane, dimension, word."""
    bits = max(1, int(values.max(initial=0)).bit_length())
    words = -(-len(values) // 64)
    out = np.zeros((bits, values.shape[1], words * 8), np.uint8)
    for k in range(bits):
        packed = np.packbits((values >> np.uint64(k) & np.uint64(1)).astype(bool), axis=0)
        out[k, :, : len(packed)] = packed.T
    return out.view(np.uint64)


def cross_products(rows: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums and, from each dimension on, sums of products of a block of whole numbers (rows x dimensions), exact."""
    n, dims = rows.shape
    least = rows.min(0)
    # differences of 64-bit numbers, right modulo 2^64
    planes = bit_planes(rows.view(np.uint64) - least.view(np.uint64))
    bits = len(planes)
    flat = planes.reshape(bits * dims, -1)
    ones = np.bitwise_count(flat).sum(1, dtype=np.int64).reshape(bits, dims)
    shifted = [sum(int(ones[k, d]) << k for k in range(bits)) for d in range(dims)]
    low = [int(x) for x in least]
    sums = [shifted[d] + n * low[d] for d in range(dims)]
    products = []
    for i in range(dims):
        # counts of the rows that have both bits, by the sum of the two planes' places
        by_weight = np.zeros((2 * bits - 1, dims - i), np.int64)
        for k in range(bits):
            common = np.bitwise_count(planes[:, i:] & planes[k, i]).sum(2, dtype=np.int64)
            by_weight[k : k + bits] += common
        row = []
        for j in range(i, dims):
            total = sum(int(c) << w for w, c in enumerate(by_weight[:, j - i]) if c)
            # the shift by each dimension's least value is undone
            row.append(total + low[i] * shifted[j] + low[j] * shifted[i] + n * low[i] * low[j])
        products.append(row)
    return sums, products


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's sums: entry (i, j) of the products, (i, -1) of the values, (-1, -1) of the rows."""
    n, sums, products = 0, [], []
    held: list[np.ndarray] = []

    def settle() -> None:
        nonlocal n, sums, products
        rows = np.concatenate(held)
        held.clear()
        one, two = cross_products(rows)
        n += len(rows)
        sums = [a + b for a, b in zip(sums, one)] if sums else one
        products = [[a + b for a, b in zip(*pair)] for pair in zip(products, two)] if products else two

    for batch in batches:
        if batch.num_rows:
            held.append(matrix(batch.column(0), np.int64))
            while sum(map(len, held)) >= BLOCK_ROWS:
                rows = np.concatenate(held)
                held[:] = [rows[:BLOCK_ROWS]]
                settle()
                if len(rows) > BLOCK_ROWS:
                    held.append(rows[BLOCK_ROWS:])
    if held:
        settle()
    if not n:
        return
    entries = [(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums))]
    entries += [(i, i + j, p) for i, row in enumerate(products) for j, p in enumerate(row)]
    i, j, totals = zip(*entries)
    high, low = (pa.array(x, pa.decimal128(38, 0)) for x in ([t >> LOW_BITS for t in totals], [t & ((1 << LOW_BITS) - 1) for t in totals]))
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), high, low], names=["i", "j", "high", "low"])


def matrix(column: pa.Array, kind) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


# --- eigenvectors ---------------------------------------------------------------


class Whitening:
    """What a fit tells: rows, exact sums, and the directions with their eigenvalues, largest first."""

    def __init__(self, n: int, sums: list[int], products: dict[tuple[int, int], int], most: int):
        dims = len(sums)
        covariance = np.empty((dims, dims))
        for (i, j), p in products.items():
            # whole numbers until here; one division, rounded once
            covariance[i, j] = covariance[j, i] = (n * p - sums[i] * sums[j]) / (n * n)
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[: min(most, dims)]
        self.n, self.sums = n, sums
        self.values, self.vectors = values[order], vectors[:, order]
        self.trace = float(np.trace(covariance))
        self.spread = self.values > FLAT * max(float(values.max()), 0.0)

    def deviations(self, rows: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """n * x - S as floating point, and the exact sum of its squares (null beyond 64 bits)."""
        reach = max(self.n * (abs(int(rows.max(initial=0))) + abs(int(rows.min(initial=0)))), *(abs(s) for s in self.sums)) * 2
        if reach * reach * len(self.sums) <= _LONG:
            apart = rows * self.n - np.array(self.sums)
            return apart.astype(np.float64), (apart * apart).sum(1).tolist()
        apart = [[self.n * int(x) - s for x, s in zip(row, self.sums)] for row in rows]
        squares = [sum(x * x for x in row) for row in apart]
        return np.array(apart, dtype=object).astype(np.float64), [s if s <= _LONG else None for s in squares]

    def whitened(self, apart: np.ndarray) -> np.ndarray:
        """Components of rows given as n * x - S; NaN in directions without variance."""
        scale = np.where(self.spread, np.sqrt(np.where(self.spread, self.values, 1.0)), np.nan)
        return (apart / self.n) @ self.vectors / scale


# --- stages ---------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector has components, none of them null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & (F.size(vector) > 0), F.lit(False))


def whitened(
    rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """Whitened components of each vector, fitted on the different vectors of whole numbers x = floor(scale * c).

    Returns vec_id, component (from 1, by falling variance), n (different vectors), deviation (exact sum of squares of n * x - S,
    null where 64 bits do not hold it), whitened, explained (share of the variance) and identity_error (largest entry of
    the whitened vectors' covariance less the identity). Rows whose vector is null, empty or holds null or non-finite entries take no part, nor do
    vectors of another length than the commonest (of equally common ones the longest). Rows that repeat an ID or have none come back
    like others. Numbers beyond 64 bits count as the nearest that fits. Where all vectors are equal in a direction, also where there
    is but one, whitened is null there, and explained is null without any variance. No rows: no result. Other columns are not read.
    """
    spark = rows.sparkSession
    found = rows.select(rows[id_col].alias("vec_id"), rows[vector_col].cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    whole = found.select("vec_id", F.transform("vector", lambda c: F.floor(c * scale).cast("long")).alias("x"))
    with temporary_tables(spark):
        sizes = whole.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
        common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
        schema = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        schema = schema.format(whole.schema["vec_id"].dataType.simpleString())
        if common is None:
            return spark.createDataFrame([], schema)
        whole = whole.where(F.size("x") == common["size"])
        # equal vectors of a task are put together before any is shuffled
        fit = written(whole.select("x").distinct(), "different-vectors")
        summed = fit.mapInArrow(_block_sums, "i int, j int, high decimal(38,0), low decimal(38,0)")
        # one row for each pair of dimensions, whatever the number of vectors
        totals = {
            (r["i"], r["j"]): (int(r["high"]) << LOW_BITS) + int(r["low"])
            for r in summed.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
        }
        n = totals.pop((-1, -1))
        sums = [totals.pop((i, -1)) for i in range(common["size"])]
        model = Whitening(n, sums, totals, components)
        spread = int(model.spread.sum())
        error = _identity_error(fit, model, spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = len(model.values)
        shares = (model.values / model.trace) if model.trace > 0 else np.full(many, np.nan)
        for batch in batches:
            if not batch.num_rows:
                continue
            apart, squares = model.deviations(matrix(batch.column(1), np.int64))
            parts = model.whitened(apart).ravel()
            each = np.repeat(np.arange(batch.num_rows), many)
            rows = len(each)
            tiled = np.tile(shares, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(rows, model.n)),
                    pa.array(squares, pa.int64()).take(pa.array(each)),
                    pa.array(parts, from_pandas=True),
                    pa.array(tiled, from_pandas=True),
                    pa.array(np.full(rows, np.nan if error is None else error), from_pandas=True),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return whole.mapInArrow(run, schema)


def _identity_error(fit: DataFrame, model: Whitening, spread: int) -> float | None:
    """Largest entry of the covariance of the fit's whitened vectors, less the identity."""
    if not spread:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = model.whitened(model.deviations(matrix(batch.column(0), np.int64))[0])[:, model.spread]
                yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in parts.T], names=[f"w{i}" for i in range(spread)])

    parts = fit.mapInArrow(run, ", ".join(f"w{i} double" for i in range(spread)))
    pairs = [(i, j) for i in range(spread) for j in range(i, spread)]
    entries = [F.abs(F.covar_pop(f"w{i}", f"w{j}") - (1.0 if i == j else 0.0)).alias(f"e{i}_{j}") for i, j in pairs]
    return max(parts.agg(*entries).first())
