"""Embedding whitening over distinct vectors weighted by their counts.

Every usable vector becomes integers ``x = floor(scale * c) + offset``.
Equal x vectors are one row of a table with their count; the count (or one,
``weights="one"``) is the row's weight in the fit:

1. sums: each task adds its rows' weighted x exactly; Spark adds the tasks'
   sums per dimension as decimals;
2. covariance: each task centres its rows on the exact mean, ``(n*x - S)/n``
   with the difference taken in integers, and multiplies them with their
   weights (one matrix product a block); Spark adds the tasks' entries;
3. the driver gets d x d sums, d being the dimension, and takes the unit
   eigenvectors of the covariance by falling eigenvalue, once for all rows;
4. every distinct vector is whitened once and written, its rows are joined
   back by the vector's digest, with a hot vector's rows split by AQE;
5. the whitened vectors' own covariance, centred on their measured mean and
   weighted alike, is compared with the identity.

Only sums of d and d x d numbers reach the driver, whatever the rows.

Defined results: rows whose vector is null or holds null or non-finite
entries take no part, nor do empty vectors and those of another length than
most (ties: the longer).  Repeated ids stay; a null id stays null.  Entries
beyond +-2**40 count as those bounds, so that x and its sums stay exact.  A
component with no spread (eigenvalue at most 1e-12 of the largest) cannot be
scaled and gives no row; equal vectors alone give no rows at all.  An empty
table gives no rows.  ``deviation`` is null where it does not fit a long
(only above some 10**8 rows, or with entries far out); ``deviation_exact``
always holds its digits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.llm.stage import written
from wareshift.operators.joins import lookup_join

#: Rows multiplied at once.
BLOCK = 4096
#: Entries beyond this count as this.
BOUND = float(1 << 40)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v: array<double>) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf))) & (F.size("v") > 0)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(fine)
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (most.n if most else 0))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _keyed(rows: DataFrame, scale: float, offset: int) -> DataFrame:
    """id, key (128-bit digest of x), x (little-endian 64-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches):
            v = np.clip(_matrix(part.column(1), np.float64), -BOUND / scale, BOUND / scale)
            x = (np.floor(scale * v).astype(np.int64) + offset).astype("<i8")
            held = [r.tobytes() for r in x]
            keys = [hashlib.blake2b(r, digest_size=16).digest() for r in held]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), pa.array(held, pa.binary())],
                                             names=["id", "key", "x"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, key binary, x binary")


def _ints(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def _sums(distinct: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list and its exact sum per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        count = 0
        for part in _blocks(batches):
            x, w = _ints(part.column(0)), part.column(1).to_numpy().astype(np.int64)
            high, low = x >> 20, x & 0xFFFFF  # keeps the products in 64 bits up to 2**42 copies
            added = [(int(h) << 20) + int(s) for h, s in zip(w @ high, w @ low)]
            total = [a + b for a, b in zip(total, added)] if total else added
            count += int(w.sum())
        values = [count, *total] if total else []
        yield pa.RecordBatch.from_arrays([
            pa.array(range(-1, len(values) - 1), pa.int32()),
            pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))], names=["dim", "total"])

    per_task = distinct.select("x", "w").mapInArrow(run, "dim int, total decimal(38,0)")
    found = {r.dim: int(r.total) for r in per_task.groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    return found.pop(-1, 0), [found[i] for i in sorted(found)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in doubles, the difference taken exactly around the rounded
    mean."""
    near = np.array([s // n for s in sums], np.int64)
    rest = np.array([float(Fraction(s, n) - s // n) for s in sums])
    return (x - near).astype(np.float64) - rest


def _products(rows: DataFrame, column: str, centre, dim: int) -> np.ndarray:
    """Weighted sums of the products of centred rows, dim x dim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for part in _blocks(batches):
            y, w = centre(part.column(0)), part.column(1).to_numpy().astype(np.float64)
            total += y.T @ (y * w[:, None])
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         names=["i", "j", "s"])

    per_task = rows.select(column, "w").mapInArrow(run, "i int, j int, s double")
    out = np.zeros((dim, dim))
    for r in per_task.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over dimensions of (n*x - S)**2."""
    near = np.array([s // n for s in sums], np.int64)
    rest = [s - n * (s // n) for s in sums]  # n*x - S = n*(x - near) - rest
    y = x - near
    square = _exact_dot(y, y)
    cross = [_exact_dot(y, np.broadcast_to(np.array([(r >> k) & 0x1FFFFF for r in rest], np.int64), y.shape))
             for k in (0, 21, 42)]
    fixed = sum(r * r for r in rest)
    return [n * n * q - 2 * n * (a + (b << 21) + (c << 42)) + fixed for q, a, b, c in zip(square, *cross)]


def _exact_dot(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Row sums of a*b as Python integers; both below 2**42 in size."""
    a_high, a_low, b_high, b_low = a >> 21, a & 0x1FFFFF, b >> 21, b & 0x1FFFFF
    high, mid, low = a_high * b_high, a_high * b_low + a_low * b_high, a_low * b_low
    return [(int(h) << 42) + (int(m) << 21) + int(s)
            for h, m, s in zip(high.sum(1), mid.sum(1), low.sum(1))]


def whiten(vectors: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000, weights: str = "counts",
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector: ``id_col``, n (rows of the fit list),
    deviation and deviation_exact, whitened (array<double>, one entry a
    component), explained (array<double>), identity_error."""
    if weights not in ("counts", "one"):
        raise ValueError(f"weights must be 'counts' or 'one', not {weights!r}")
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    keyed = _keyed(rows, scale, offset)
    weight = F.count("*") if weights == "counts" else F.lit(1).cast("bigint")
    distinct = written(keyed.groupBy("key", "x").agg(weight.alias("w")), "whiten-distinct")
    n, sums = _sums(distinct)
    schema = T.StructType([
        T.StructField(id_col, rows.schema["id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("deviation_exact", T.StringType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("explained", T.ArrayType(T.DoubleType())),
        T.StructField("identity_error", T.DoubleType())])
    if not n:
        return spark.createDataFrame([], schema)
    dim = len(sums)
    covariance = _products(distinct, "x", lambda c: _centred(_ints(c), n, sums), dim) / n
    values, vectors_of = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > max(values.max(), 0) * 1e-12][:components]
    if not len(order):
        return spark.createDataFrame([], schema)
    scaled = vectors_of[:, order] / np.sqrt(values[order])
    explained = (values[order] / np.trace(covariance)).tolist()
    k = len(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches):
            x = _ints(part.column(1))
            z = _centred(x, n, sums) @ scaled
            far = _deviation(x, n, sums)
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(2),
                pa.array([d if d < 1 << 63 else None for d in far], pa.int64()),
                pa.array([str(d) for d in far], pa.string()),
                pa.FixedSizeListArray.from_arrays(pa.array(z.reshape(-1)), k).cast(pa.list_(pa.float64())),
            ], names=["key", "w", "deviation", "digits", "z"])

    white = written(distinct.select("key", "x", "w").mapInArrow(
        run, "key binary, w bigint, deviation bigint, digits string, z array<double>"), "whiten-distinct-z")
    mean = np.array(white.agg(*[F.sum(F.col("z")[i] * F.col("w")).alias(f"s{i}") for i in range(k)]).first()) / n
    product = _products(white, "z", lambda c: _matrix(c, np.float64) - mean, k) / n
    error = float(np.abs(product - np.eye(k)).max())

    looked = white.select(F.col("key").alias("of"), "deviation", "digits", "z")
    back = lookup_join(keyed.select("id", "key"), looked, ["key"], ["of"], "inner")
    return back.select(
        F.col("id").alias(id_col), F.lit(n).cast("bigint").alias("n"),
        "deviation", F.col("digits").alias("deviation_exact"), F.col("z").alias("whitened"),
        F.lit(explained).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"))


def by_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row per vector and component, numbered from 1."""
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("p", "c")
    return whitened.select(f"`{id_col}`", "n", "deviation", "deviation_exact", "identity_error", one).select(
        f"`{id_col}`", (F.col("p") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error", "deviation_exact")
