"""Approximate nearest neighbours: multiprobe p-stable hashing.

Each of ``tables`` tables cuts the space with ``m`` random Gaussian
projections into cells of one width; a vector's cell is its bucket.  A query
visits the buckets around its own in the order of the estimated chance that
a neighbour at the typical distance lies there (for a Gaussian projection
each cell's chance is a difference of normal distributions; the product over
the projections is enumerated best first), until the chances add up to
``mass``.  The candidates of all tables are merged and ranked by the exact
distance on the original vectors.

At scale: equal vectors are one entry of the index (with their ``k + 1``
smallest ids, all that a result can show; each task keeps no more of a
vector before the shuffle).  A bucket above ``block`` entries is dealt to
several tasks and the queries that visit it in blocks of about
``QUERY_BLOCK``, so that a task holds one part and one block; each gives a
query at most k rows.  Queries that find fewer than k rows are compared with
all vectors, in blocks of queries and parts of the index alike.

``m`` follows the number of vectors (about 256 to a bucket); the cell width
and the typical neighbour distance come from a sample of ``sample`` vectors.

Defined results: vectors null, zero, of another length than most, or holding
null or non-finite components take no part; rows that repeat an id and vector count
once; an id with several vectors asks with the smallest of them (in array
order) and is as near to others as its nearest one, and never its own
neighbour; ties go to the smaller id; an empty table has no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareshift.llm.stage import written
from wareshift.operators.joins import lookup_join

#: Queries that one task compares with its part of the entries, about.
QUERY_BLOCK = 2048


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v: array<double>) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & fine)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (lengths.n if lengths else 0))


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): one row per distinct vector with its smallest ids.  The
    window's limit is applied in each task before the shuffle, so a vector
    that very many rows share sends ``keep`` rows a task."""
    order = Window.partitionBy("v").orderBy("id")
    first = rows.select("v", "id").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


class Tables:
    """The projections of all tables."""

    def __init__(self, dim: int, n: int, sample: np.ndarray, tables: int, seed: int):
        self.m = max(1, int(math.log(max(n / 256, 4), 4)))
        self.tables = tables
        rng = np.random.default_rng(seed)
        self.a = rng.standard_normal((dim, tables * self.m))
        spread = np.std(sample @ self.a) if len(sample) else 1.0
        self.w = float(spread) or 1.0
        self.b = rng.random(tables * self.m) * self.w
        self.d = _typical(sample) or self.w
        self.spread = np.random.default_rng(seed + 1).integers(1, 1 << 62, self.m) | 1

    def places(self, x: np.ndarray) -> np.ndarray:
        """Positions in units of cells, rows x (tables * m)."""
        return (x @ self.a + self.b) / self.w

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """A bucket's 64-bit key from its m cell numbers (last axis).  Two
        buckets with one key only add candidates."""
        with np.errstate(over="ignore"):
            h = (cells.astype(np.int64) * self.spread).sum(axis=-1)
            return h ^ (h >> np.int64(29))

    def probes(self, place: np.ndarray, mass: float, reach: int = 8) -> np.ndarray:
        """Cells of the buckets to visit, best first, for one table's place.
        Cells beyond ``reach`` hold a vanishing chance."""
        options = []
        for x in place:
            cell = math.floor(x)
            near = np.arange(cell - reach, cell + reach + 1)
            edges = (np.append(near, near[-1] + 1) - x) * self.w / self.d
            chance = np.diff(np.array([0.5 * math.erfc(-e / math.sqrt(2)) for e in edges]))
            order = np.argsort(-chance, kind="stable")
            order = order[chance[order] > 1e-6]
            options.append(([-math.log(c) for c in chance[order]], near[order]))
        heap = [(sum(o[0][0] for o in options), (0,) * len(options), 0)]
        out, total = [], 0.0
        while heap and total < mass:
            cost, at, least = heapq.heappop(heap)
            total += math.exp(-cost)
            out.append([options[i][1][j] for i, j in enumerate(at)])
            for i in range(least, len(at)):
                j = at[i] + 1
                if j < len(options[i][0]):
                    heapq.heappush(heap, (cost - options[i][0][j - 1] + options[i][0][j], at[:i] + (j,) + at[i + 1 :], i))
        return np.array(out, np.int64)


def _typical(sample: np.ndarray) -> float:
    """Median distance to the tenth neighbour within the sample."""
    if len(sample) < 2:
        return 0.0
    square = (sample**2).sum(1)
    tenth = []
    for lo in range(0, len(sample), 256):
        d = np.maximum(square[lo : lo + 256, None] + square[None] - 2 * sample[lo : lo + 256] @ sample.T, 0)
        tenth.append(np.partition(d, min(10, len(sample) - 1), axis=1)[:, min(10, len(sample) - 1)])
    return float(np.sqrt(np.median(np.concatenate(tenth))))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _nearest(q_ids: np.ndarray, q: np.ndarray, ids: list, x: np.ndarray, k: int) -> tuple[list, list, list]:
    """Each query's k nearest ids of one block, its own id left out."""
    out_q, out_id, out_d = [], [], []
    sizes = np.array([len(i) for i in ids])
    flat = np.concatenate([np.asarray(i, np.int64) for i in ids])
    begin = np.cumsum(sizes) - sizes
    for qid, one in zip(q_ids.tolist(), q):
        diff = x - one
        d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        if len(d) > k + 1:  # of k + 1 entries one can be the query's own
            d_k = np.partition(d, k)[k]
            near = np.flatnonzero(d <= d_k)
        else:
            near = np.arange(len(d))
        at = np.concatenate([np.arange(begin[i], begin[i] + sizes[i]) for i in near])
        dist = np.repeat(d[near], sizes[near])
        own = flat[at] != qid
        at, dist = at[own], dist[own]
        best = np.lexsort((flat[at], dist))[:k]
        out_q += [qid] * len(best)
        out_id += flat[at[best]].tolist()
        out_d += dist[best].tolist()
    return out_q, out_id, out_d


def nearest_neighbours(vectors: DataFrame, query_every: int, k: int = 10, tables: int = 4, mass: float = 0.5,
                       block: int = 1024, sample: int = 2000, seed: int = 20, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score for the rows whose id is divisible by
    ``query_every``, searched in all rows."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    index = written(entries(rows, k + 1), "ann-index")
    n = index.count()
    schema = "query_id bigint, vec_id bigint, score double"
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    picked = index.orderBy(F.xxhash64("v")).limit(sample).select("v").collect()
    taken = np.array([r.v for r in picked], float)
    dim = taken.shape[1]
    t = Tables(dim, n, taken, tables, seed)
    queries = rows.where(F.col("id") % query_every == 0).groupBy("id").agg(F.min("v").alias("v"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            cells = np.floor(t.places(x)).astype(np.int64).reshape(len(x), tables, t.m)
            keys = t.keys(cells)
            for j in range(tables):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(x), j), pa.int32()), pa.array(keys[:, j]), batch.column(0), batch.column(1)],
                    names=["t", "bucket", "v", "ids"])

    placed = index.select("v", "ids").mapInArrow(place, "t int, bucket bigint, v array<double>, ids array<bigint>")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            places = t.places(x).reshape(len(x), tables, t.m)
            for i in range(len(x)):
                for j in range(tables):
                    keys = np.unique(t.keys(t.probes(places[i, j], mass)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(keys), j), pa.int32()), pa.array(keys),
                        pa.array(np.repeat(batch.column(0)[i].as_py(), len(keys)), pa.int64())],
                        names=["t", "bucket", "id"])

    sizes = placed.groupBy("t", "bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    probes = written(queries.select(F.col("id").cast("bigint"), "v").mapInArrow(probe, "t int, bucket bigint, id bigint"),
                     "ann-probes")
    # only buckets that exist are visited; a large one part by part, and by
    # many queries block by block
    blocks = probes.groupBy("t", "bucket").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    plan = sizes.join(blocks, ["t", "bucket"])
    plan = plan.select(F.col("t").alias("of_t"), F.col("bucket").alias("of_bucket"), "parts", "blocks")
    at = (["t", "bucket"], ["of_t", "of_bucket"])
    visits = lookup_join(probes, plan, *at, "inner").select(
        "t", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id")
    visits = visits.join(queries.select(F.col("id").cast("bigint").alias("id"), "v"), "id")
    dealt = lookup_join(placed, plan, *at, "inner").select(
        "t", "bucket", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "v", "ids")

    def rank(found: pa.Table, asked: pa.Table) -> pa.Table:
        out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not found.num_rows or not asked.num_rows:
            return out.empty_table()
        got = _nearest(asked.column("id").to_numpy(), _matrix(asked.column("v"), dim),
                       found.column("ids").to_pylist(), _matrix(found.column("v"), dim), k)
        return pa.table([pa.array(c, f.type) for c, f in zip(got, out)], schema=out)

    keys = ["t", "bucket", "part", "block"]
    found = dealt.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(rank, schema)
    found = written(found, "ann-found")
    best = top(found, k)
    wanted = F.least(F.lit(k), F.lit(rows.select("id").distinct().count() - 1))
    have = best.groupBy("query_id").count()
    short = (queries.select(F.col("id").cast("bigint").alias("query_id"), "v").join(have, "query_id", "left")
             .where(F.coalesce("count", F.lit(0)) < wanted).select("query_id", "v"))
    short = written(short, "ann-short")
    n_short = short.count()
    if n_short:
        best = best.join(short.select("query_id"), "query_id", "left_anti").unionByName(
            top(_compare_with_all(short, n_short, index, n, block, rank, schema), k))
    return best.select("query_id", "rank", "vec_id", "score")


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best distinct candidates of each query."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


def _compare_with_all(asked: DataFrame, n_asked: int, index: DataFrame, n: int, block: int, rank, schema: str) -> DataFrame:
    """Exact search for the given queries: every block of queries meets every
    part of the index in a task of its own."""
    blocks, parts = -(-n_asked // QUERY_BLOCK), -(-n // block)
    x = index.select(F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int").alias("part"),
                     F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "v", "ids")
    q = asked.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                     F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), F.col("query_id").alias("id"), "v")
    return x.groupBy("part", "block").cogroup(q.groupBy("part", "block")).applyInArrow(rank, schema)
