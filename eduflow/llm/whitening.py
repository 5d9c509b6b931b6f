"""Embeddings turned to components of unit variance, from exact cross-products.

Entries become whole numbers (`SCALE` times, rounded down). A task takes its rows in blocks; in a block every dimension
is shifted by its least value, and each bit of the shifted numbers is packed across the rows into 64-bit words. The
cross-product of two dimensions is the sum over pairs of bits of the number of rows that have both (an AND and a
population count) times the weights of the bits; shifts are put back as whole numbers. Tasks' sums are added by Spark as
decimals, and n * products - sums * sums is the centred scatter as whole numbers, before anything is rounded. The driver
gets one number per pair of dimensions and solves for the eigenvectors; rows never leave the tasks.

Rows go whose vector is null, empty, or holds null, NaN, an infinity or an entry of 2^40 or more, which the sums could
not hold exactly; and those whose length is not the commonest one (of equally common lengths, the longer). All
other rows count, repeated ids too, a null id as well. Components beyond the rank of the data have 0 for all rows and are
left out of the error; rank is told in double precision, so spreads that differ by more than about 10^7 between
dimensions lose the smallest. A deviation beyond a long is null. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eduflow.llm.common import importable

#: Fixed values of the whole numbers: floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
BLOCK = 16_384
LARGEST = float(1 << 40)


class Whitening(NamedTuple):
    n: int
    sums: list[int]  # per dimension, without OFFSET
    trace: float
    values: list[float]  # eigenvalues, falling
    weights: np.ndarray  # dimension x component, eigenvector over the root of its value


def fit_rows(rows: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """The rows that count: struct `row` of the columns to keep, and the vector as `entries`."""
    fine = F.forall("entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    kept = rows.select(F.struct(*[rows[c] for c in keep]).alias("row"), rows[vector].cast("array<double>").alias(
        "entries")).where(fine & (F.size("entries") > 0))
    sizes = kept.groupBy(F.size("entries").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return kept.where(F.size("entries") == (sizes.size if sizes else 0))


def numbers(entries: pa.Array) -> np.ndarray:
    """Rows x dimensions of whole numbers, without OFFSET."""
    flat = np.floor(SCALE * entries.flatten().to_numpy(zero_copy_only=False))
    return flat.astype(np.int64).reshape(len(entries), -1)


def bit_planes(shifted: np.ndarray, bits: int) -> np.ndarray:
    """Dimensions x bits x words: bit b of every row's number, 64 rows to a word."""
    rows, width = shifted.shape
    planes = np.zeros((width, bits, -(-rows // 64) * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits((shifted.T >> b & 1).astype(np.uint8), axis=1)
        planes[:, b, : packed.shape[1]] = packed
    return planes.view(np.uint64)


def block_products(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of a block's columns, as Python numbers (upper triangle)."""
    rows, width = z.shape
    least = z.min(axis=0)
    shifted = z - least
    bits = max(1, int(shifted.max()).bit_length())
    planes = bit_planes(shifted, bits)
    kind = np.int64 if 2 * bits + rows.bit_length() < 62 else object
    weight = np.array([1 << b for b in range(bits)], kind)
    sums = (np.bitwise_count(planes).sum(axis=2, dtype=np.int64).astype(kind) * weight).sum(axis=1)
    products = np.zeros((width, width), object)
    for i in range(width):
        line = np.zeros(width - i, kind)
        for b in range(bits):
            both = np.bitwise_count(planes[i:] & planes[i, b]).sum(axis=2, dtype=np.int64)
            line += (both.astype(kind) * weight).sum(axis=1) * weight[b]
        products[i, i:] = line.astype(object)
    sums, least = sums.astype(object), least.astype(object)
    products += np.triu(np.outer(least, sums) + np.outer(sums, least) + rows * np.outer(least, least))
    return sums + rows * least, products


def scatter(kept: DataFrame) -> DataFrame:
    """i, j, total: cross-products where 0 <= i <= j, sums of dimension j where i is -1, the number of rows at -1, -1."""
    schema = "i int, j int, total decimal(38,0)"
    names, kinds = ["i", "j", "total"], [pa.int32(), pa.int32(), pa.decimal128(38, 0)]

    def run(batches):
        n, sums, products = 0, None, None
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                z = numbers(batch.column(0).slice(start, BLOCK))
                s, p = block_products(z)
                n, sums, products = n + len(z), s if sums is None else sums + s, p if products is None else products + p
        if not n:
            return
        i, j = np.triu_indices(len(sums))
        rows = np.concatenate([[-1], np.full(len(sums), -1), i]), np.concatenate([[-1], np.arange(len(sums)), j])
        total = [n, *sums, *products[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], kinds[0]), pa.array(rows[1], kinds[1]), pa.array(map(Decimal, total), kinds[2])], names)

    return kept.select("entries").mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("total").alias("total"))


def fitted(kept: DataFrame, most: int = 32) -> Whitening | None:
    """Of the rows given; None without any. The driver holds one number per pair of dimensions."""
    importable(kept.sparkSession)
    found = {(r.i, r.j): int(r.total) for r in scatter(kept).collect()}
    if not found:
        return None
    n, width = found[-1, -1], max(j for _, j in found) + 1
    sums = [found[-1, j] for j in range(width)]
    exact = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            exact[i, j] = exact[j, i] = (n * found[i, j] - sums[i] * sums[j]) / n**2
    trace = sum(n * found[i, i] - sums[i] ** 2 for i in range(width)) / n**2
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    rank = values > trace * width * np.finfo(float).eps
    weights = np.where(rank, vectors / np.sqrt(np.where(rank, values, 1)), 0)
    return Whitening(n, sums, trace, np.where(rank, values, 0).tolist(), weights)


def centred(z: np.ndarray, fit: Whitening) -> np.ndarray:
    """n * x - S exactly; the offset of x cancels."""
    if max(abs(int(z.min())), abs(int(z.max())), 1) * fit.n + max(map(abs, fit.sums)) < 1 << 62:
        return z * fit.n - np.array(fit.sums, np.int64)
    return z.astype(object) * fit.n - np.array(fit.sums, object)


def projected(u: np.ndarray, fit: Whitening) -> np.ndarray:
    return (u.astype(np.float64) / fit.n) @ fit.weights


def square_sums(u: np.ndarray) -> np.ndarray:
    if u.dtype != object and int(np.abs(u).max()) ** 2 * u.shape[1] < 1 << 62:
        return (u * u).sum(axis=1)
    u = u.astype(object)
    return (u * u).sum(axis=1)


def whitened(kept: DataFrame, fit: Whitening) -> DataFrame:
    """`row`, `deviation` (sum of (n * x - S)^2) and `whitened`, one number a component.

    A deviation beyond 38 digits is null.
    """
    schema = T.StructType([kept.schema["row"], T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    names, kinds = schema.names, to_arrow_schema(schema).types

    def run(batches):
        with localcontext(prec=60):
            for batch in batches:
                if not len(batch):
                    continue
                u = centred(numbers(batch.column(1)), fit)
                squares = [Decimal(int(x)) if abs(int(x)) < 10**38 else None for x in square_sums(u)]
                made = projected(u, fit)
                lists = pa.ListArray.from_arrays(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), made.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(squares, kinds[1]), lists.cast(kinds[2])], names)

    return kept.mapInArrow(run, schema)


def identity_error(kept: DataFrame, fit: Whitening) -> float:
    """Largest difference between the covariance of the whitened rows, taken over all of them, and the identity."""
    width = fit.weights.shape[1]

    def run(batches):
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if len(batch):
                made = projected(centred(numbers(batch.column(0)), fit), fit)
                made = np.concatenate([made, np.ones((len(made), 1))], axis=1)
                total += made.T @ made
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          pa.array(total.ravel())], ["i", "j", "total"])

    rows = kept.select("entries").mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(
        F.sum("total").alias("total")).collect()
    total = np.zeros((width + 1, width + 1))
    for r in rows:
        total[r.i, r.j] = r.total
    mean = total[:width, width] / fit.n
    found = total[:width, :width] / fit.n - np.outer(mean, mean) - np.eye(width)
    rank = np.array(fit.values) > 0
    return float(np.abs(found[np.ix_(rank, rank)]).max(initial=0.0))


def components(rows: DataFrame, key: str, vector: str, most: int = 32) -> DataFrame:
    """One row per remaining row and component, numbered from 1 by falling eigenvalue."""
    kept = fit_rows(rows, vector, [key])
    fit = fitted(kept, most) or Whitening(0, [], 0.0, [], np.zeros((0, 0)))
    error = identity_error(kept, fit) if fit.n else 0.0
    share = [v / fit.trace if fit.trace else 0.0 for v in fit.values]
    explained: Column = F.element_at(F.array(*map(F.lit, share or [0.0])), F.col("component"))
    wide = whitened(kept, fit).select(F.col("row").getField(key).alias(key), "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return wide.withColumn("component", F.col("place") + 1).select(
        key, "component", F.lit(fit.n).cast("long").alias("n"), F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
