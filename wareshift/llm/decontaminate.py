"""Benchmark decontamination: size-partitioned MinHash containment search.

A benchmark item is found in a document if the document holds at least
``threshold`` of the item's distinct five-word shingles.  An item's Jaccard
similarity with a long document is near zero whatever it contains, so the
sketch is of the item alone: its smallest shingle fingerprints, a uniform
sample of its shingles, looked up among the document's.

Items are partitioned by size (powers of two of their shingle count); a
class's largest item sets how many shingles may be missing and with that the
sketch: twice that many and eight more.  A document that contains an item
misses at most ``missing`` of the sketch, so it holds at least
``len(sketch) - missing`` of it: no containing document is lost, and only the
few that pass are verified by exact containment of the whole shingle set.
Documents too short for a class are not looked up in it.

Words are runs of letters, digits and non-ASCII characters of the lower-case
text, so case and punctuation do not hide a passage.  Items with fewer than
five words are one shingle of their own length.

Scale: a benchmark of at most ``block_shingles`` shingles (counted; any
usual one) goes to the tasks whole, and the documents are read in one map
and never shuffled.  A larger one stays a table: the documents' shingles that
pass a filter of fixed size over all sketches meet the sketches in a join,
and the few pairs that hold enough of a sketch fetch text and item to be
verified.  Equal texts are looked up once; nothing but the filter passes
through the driver.

Defined results: null or empty texts, and items without words, match
nothing; repeated rows are judged one by one; items that repeat an id are
items of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.llm.stage import written
from wareshift.llm.text import NOT_ALNUM, Words, slices
from wareshift.operators.joins import lookup_join

N = 5
_BITS = 20
#: Size of the filter over a large benchmark's sketches (16 MB).
FILTER_BITS = 27


@dataclass
class SizeClass:
    """Items of one shingle length and of from ``low`` to ``2 * low - 1``
    shingles.  ``fingerprint``/``item``: the sketches, sorted."""

    n: int
    least: int  # shingles that the smallest item needs
    fingerprint: np.ndarray
    item: np.ndarray
    bits: np.ndarray


def _grams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    whole = words.whole(n)
    return words.row[: len(whole)][whole], words.grams(hashes, n)[whole]


def item_shingles(texts: pa.Array) -> list[tuple[int, np.ndarray]]:
    """(shingle length, distinct fingerprints) of each text."""
    words = Words(texts, NOT_ALNUM)
    hashes = words.hashes()
    out: list[tuple[int, np.ndarray]] = [(0, np.zeros(0, np.uint64))] * len(words.counts)
    for n in range(1, N + 1):
        row, gram = _grams(words, hashes, n)
        for i in np.flatnonzero(words.counts >= N if n == N else words.counts == n):
            out[i] = (n, np.unique(gram[row == i]))
    return out


def needed(size: int, threshold: float) -> int:
    """Least shared shingles that reach the threshold (in whole numbers of
    thousandths, so that 0.8 of 5 is 4)."""
    return -(-size * round(threshold * 1000) // 1000)


class Block:
    """A bounded number of items, ready to be looked up."""

    def __init__(self, shingles: list[tuple[int, np.ndarray]], threshold: float):
        self.shingles = [s for _, s in shingles]
        self.n = [n for n, _ in shingles]
        self.need = np.array([needed(len(s), threshold) for _, s in shingles], np.int64)
        self.sketch_need = np.zeros(len(shingles), np.int64)
        members: dict[tuple[int, int], list[int]] = {}
        for i, (n, s) in enumerate(shingles):
            if len(s):
                members.setdefault((n, len(s).bit_length()), []).append(i)
        self.classes = []
        for (n, log), items in sorted(members.items()):
            top = (1 << log) - 1
            size = 8 + 2 * (top - needed(top, threshold))
            parts = []
            for i in items:
                s = self.shingles[i]  # sorted: its first are the smallest
                sketch = s[:size]
                self.sketch_need[i] = max(1, len(sketch) - (len(s) - self.need[i]))
                parts.append((sketch, np.full(len(sketch), i)))
            fingerprint = np.concatenate([p[0] for p in parts])
            item = np.concatenate([p[1] for p in parts])
            order = np.argsort(fingerprint, kind="stable")
            bits = np.zeros(1 << _BITS, bool)
            bits[fingerprint >> np.uint64(64 - _BITS)] = True
            self.classes.append(SizeClass(n, int(min(self.need[items])), fingerprint[order], item[order], bits))

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, shared shingles) of each contained item."""
        words = Words(texts, NOT_ALNUM)
        hashes = words.hashes()
        out: list[tuple[int, int, int]] = []
        lengths = sorted({c.n for c in self.classes})
        for n in lengths:
            row, gram = _grams(words, hashes, n)
            for c in (c for c in self.classes if c.n == n):
                maybe = np.flatnonzero(c.bits[gram >> np.uint64(64 - _BITS)])
                maybe = maybe[words.counts[row[maybe]] - n + 1 >= c.least]
                g, r = gram[maybe], row[maybe]
                lo = np.searchsorted(c.fingerprint, g, side="left")
                hit = (lo < len(c.fingerprint)) & (c.fingerprint[np.minimum(lo, len(c.fingerprint) - 1)] == g)
                if not hit.any():
                    continue
                seen = np.unique(np.stack([r[hit].astype(np.uint64), g[hit]]), axis=1)
                r, g = seen[0].astype(np.int64), seen[1]
                lo = np.searchsorted(c.fingerprint, g, side="left")
                size = np.searchsorted(c.fingerprint, g, side="right") - lo
                at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
                pair, shared = np.unique(np.repeat(r, size) * len(self.need) + c.item[at], return_counts=True)
                item = pair % len(self.need)
                for p in pair[shared >= self.sketch_need[item]].tolist():
                    doc, i = divmod(p, len(self.need))
                    a, b = np.searchsorted(row, [doc, doc + 1])
                    both = int(np.isin(self.shingles[i], gram[a:b]).sum())
                    if both >= self.need[i]:
                        out.append((doc, i, both))
        found = np.array(sorted(out), np.int64).reshape(-1, 3)
        return found[:, 0], found[:, 1], found[:, 2]


def _item_sets(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, s): each item's shingle length and distinct shingles."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.lower(F.col(f"`{text_col}`").cast("string")).alias("text"))
    schema = T.StructType([items.schema["id"], T.StructField("n", T.IntegerType()), T.StructField("s", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = item_shingles(batch.column(1))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n for n, _ in found], pa.int32()),
                pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))], names=["id", "n", "s"])

    return items.mapInArrow(run, schema).where("n > 0")


def mark(docs: DataFrame, benchmark: DataFrame, carry: list[str], threshold: float = 0.8,
         block_shingles: int = 2_000_000, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """One row per document: ``row`` (struct of the ``carry`` columns) and
    ``items``, the contained items as (item_id, shared, size)."""
    items_type = T.ArrayType(T.StructType([
        T.StructField("item_id", benchmark.schema[item_col].dataType), T.StructField("shared", T.LongType()),
        T.StructField("size", T.LongType())]))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
                      F.lower(F.col(f"`{text_col}`").cast("string")).alias("text"),
                      F.array().cast(items_type).alias("items"))
    sets = _item_sets(benchmark, item_col, item_text_col)
    total = sets.agg(F.sum(F.size("s")).alias("n")).first().n or 0
    if total > block_shingles:
        return _mark_by_join(src, sets, threshold, items_type)
    rows = sets.collect()  # at most block_shingles numbers
    if rows:
        found = [(r.n, np.array(r.s, np.int64).view(np.uint64)) for r in rows]
        src = src.mapInArrow(_marker([r.id for r in rows], found, threshold), src.schema)
    return src.select("row", "items")


def _sketches(threshold: float):
    """(no, n, fp, enough): an item's sketch, and how much of it a document
    that contains the item holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, n, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                s = np.asarray(s.as_py(), np.int64).view(np.uint64)  # sorted as unsigned
                top = (1 << len(s).bit_length()) - 1
                sketch = s[: 8 + 2 * (top - needed(top, threshold))]
                enough = max(1, len(sketch) - (len(s) - needed(len(s), threshold)))
                k = len(sketch)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(k, no)), pa.array(np.full(k, n), pa.int32()), pa.array(sketch.view(np.int64)),
                    pa.array(np.full(k, enough), pa.int64())], names=["no", "n", "fp", "enough"])

    return run


def _filter(sketches: DataFrame) -> np.ndarray:
    """Which leading bits occur among the sketches: 2**FILTER_BITS bits,
    whatever the benchmark's size."""
    place = F.shiftrightunsigned("fp", 64 - FILTER_BITS)
    words = sketches.select(F.shiftright(place, 6).alias("at"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(fp, {64 - FILTER_BITS}) & 63 AS INT))").alias("bit"))
    got = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # 2**(FILTER_BITS - 6) numbers at most
    out = np.zeros(1 << FILTER_BITS - 6, np.int64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out


def _mark_by_join(src: DataFrame, sets: DataFrame, threshold: float, items_type: T.ArrayType) -> DataFrame:
    spark = src.sparkSession
    items = written(sets.withColumn("no", F.monotonically_increasing_id()), "items")
    sketches = written(items.select("no", "n", "s").mapInArrow(_sketches(threshold), "no bigint, n int, fp bigint, enough bigint"),
                       "sketches")
    lengths = sorted(r.n for r in items.select("n").distinct().collect())  # N at most
    held = spark.sparkContext.broadcast(_filter(sketches))
    keyed = src.select("row", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column(2), NOT_ALNUM)
                hashes = words.hashes()
                for n in lengths:
                    row, gram = _grams(words, hashes, n)
                    place = (gram >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    some = np.flatnonzero((bits[place >> 6] >> (place & 63)) & 1)
                    row, gram = row[some], gram[some]
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                        pa.array(np.full(len(row), n), pa.int32()), pa.array(gram.view(np.int64))], names=["k1", "k2", "n", "fp"])

    seen = keyed.where("text IS NOT NULL").select("k1", "k2", "text").mapInArrow(
        grams, "k1 bigint, k2 bigint, n int, fp bigint").distinct()
    pairs = written(seen.join(sketches, ["n", "fp"]).groupBy("k1", "k2", "no").agg(
        F.count("*").alias("shared"), F.first("enough").alias("enough")).where("shared >= enough").select("k1", "k2", "no"), "contained")
    texts = keyed.select("k1", "k2", "text").join(pairs.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").distinct()
    asked = pairs.join(items, "no").join(texts, ["k1", "k2"]).select("k1", "k2", "id", "n", "s", "text")
    schema = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                           *[T.StructField(f.name, f.dataType) for f in items_type.elementType.fields]])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, size, keep = [], [], []
            for i, (n, s) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4))):
                words = Words(batch.column(5).slice(i, 1), NOT_ALNUM)
                item = np.asarray(s.as_py(), np.int64).view(np.uint64)
                both = int(np.isin(item, _grams(words, words.hashes(), n)[1]).sum())
                if both >= needed(len(item), threshold):
                    shared.append(both)
                    size.append(len(item))
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), pa.array(shared, pa.int64()),
                pa.array(size, pa.int64())], names=schema.names)

    found = asked.mapInArrow(verify, schema).groupBy(F.col("k1").alias("of1"), F.col("k2").alias("of2")).agg(
        F.collect_list(F.struct("item_id", "shared", "size")).alias("found"))
    out = lookup_join(keyed.select("row", "k1", "k2"), found, ["k1", "k2"], ["of1", "of2"], "left")
    return out.select("row", F.coalesce("found", F.array().cast(items_type)).alias("items"))


def _marker(ids: list, shingles: list[tuple[int, np.ndarray]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shingles, threshold)
        for batch in batches:
            for part in slices(batch):
                row, item, shared = block.find(part.column(1))
                items = part.column(2)
                if len(row):
                    lists = items.to_pylist()
                    for r, i, s in zip(row.tolist(), item.tolist(), shared.tolist()):
                        lists[r] = lists[r] + [{"item_id": ids[i], "shared": s, "size": len(block.shingles[i])}]
                    items = pa.array(lists, items.type)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), items], names=["row", "text", "items"])

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    marked = mark(docs, benchmark, docs.columns, **options).where(F.size("items") == 0)
    return marked.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
