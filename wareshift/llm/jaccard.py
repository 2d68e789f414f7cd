"""N-gram Jaccard join: rare-first prefix filtering with length, positional
and suffix filters, verified once per pair.

Documents are sets of word shingles.  Equal sets are one class.  For classes
that may link (100 * intersection >= percent * union):

1. Rare-first order: shingles that recur within a slice of the corpus are
   counted over the whole corpus; a table of the most frequent ones, of
   bounded size, puts those last by count, all others come first by
   fingerprint.  Any common order gives exact results.
2. Prefix join: two sets that link share at least three of their first
   ``n - ceil(percent * n) + 3`` shingles.  A filter of fixed size keeps what
   no other prefix has from the shuffle.  Classes meet on prefix shingles,
   pass the length and positional filters, and are candidates if they share
   three and their sketches allow it: 64 counts of the set's shingles by
   hash, whose differences add up to no more than the sets differ by.  So
   sets that share a few shingles by chance, whose number grows with the
   square of the corpus, end here.  A prefix shingle of more than ``block``
   classes makes no pairs: those of two neighbouring length bands come into
   one task, which links them by their sketches and returns one edge a class;
   above ``crowd`` they are tied to one leader.  That loses nothing.
3. The texts of candidates, found by a filter of fixed size, are fetched.
   Candidates that hang together come into one task with their whole sets (a
   large cluster is cut into tiles, all pairs of tiles).  There each pair is
   met once, through its first common prefix shingle in the order of the
   task's own counts, filtered by length, position and the suffix's
   halves, and verified exactly.  A task returns a row per class: the root
   of its links there and its number of links, never the pairs.
4. Components of those rows, joined back to the documents.

Sets too small to differ by one shingle (below nine at 90 percent) link with
equal sets only, so they need no join.

Defined results: null or wordless texts have an empty set and link with
nothing; repeated rows are equal sets; a null id never names a component
unless all its ids are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareshift.llm.bitfilter import bit_filter, passed
from wareshift.llm.components import components
from wareshift.llm.stage import written
from wareshift.llm.text import Words, shingles, slices
from wareshift.operators.joins import lookup_join

#: Shared prefix shingles asked of a candidate pair.
SHARED = 3
#: Shingles gathered in a task before those that recur are handed on.
GATHER = 3_000_000
#: Counts of a set's sketch.
SKETCH = 64
_BITS = 22


def needed(n, percent: int):
    """Least intersection of a set of n with any set it links to."""
    return -(-percent * n // 100)


def smallest(percent: int) -> int:
    """Least shingles of a set that can link with an unequal one."""
    return -(-100 // (100 - percent)) - 1 if percent < 100 else 1 << 62


def pair_needed(a, b, percent: int):
    """Least intersection of linked sets of a and b shingles."""
    return -(-percent * (a + b) // (100 + percent))


class Order:
    """Counts of the most frequent shingles; 0 for all others."""

    def __init__(self, shingle: np.ndarray, count: np.ndarray):
        at = np.argsort(shingle)
        self.shingle, self.n = shingle[at], count[at]
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[self.shingle >> np.uint64(64 - _BITS)] = True

    def counts(self, gram: np.ndarray) -> np.ndarray:
        out = np.zeros(len(gram), np.int64)
        if len(self.shingle):
            maybe = np.flatnonzero(self.bits[gram >> np.uint64(64 - _BITS)])
            g = gram[maybe]
            at = np.minimum(np.searchsorted(self.shingle, g), len(self.shingle) - 1)
            out[maybe] = np.where(self.shingle[at] == g, self.n[at], 0)
        return out


def frequent(texts: DataFrame, n: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The corpus counts of at most ``table`` shingles, the most frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            gram, count = np.unique(np.concatenate(held), return_counts=True)
            again = count > 1
            return pa.RecordBatch.from_arrays([pa.array(gram[again].view(np.int64)), pa.array(count[again])],
                                              names=["h", "n"])

        for batch in batches:
            for part in slices(batch):
                words = Words(part.column(0))
                held.append(words.grams(words.hashes(fold_case=True), n)[words.whole(n)])
                size += len(held[-1])
                if size > GATHER:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    counts = written(texts.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")),
                     "shingle-counts")
    least, total = 2, 0
    # distinct counts are few: one row per count below 1000, and one for the rest
    steps = counts.groupBy(F.least("n", F.lit(1000)).alias("n")).count().orderBy(F.desc("n")).collect()
    for step in steps:
        total += step["count"]
        if total > table:
            least = step.n + 1
            break
    top = counts.where(F.col("n") >= least).select("h", "n")
    if least > 1000:
        top = top.orderBy(F.desc("n"), "h").limit(table)
    got = top.toArrow()
    return got.column("h").to_numpy().view(np.uint64), got.column("n").to_numpy()


def signatures(docs: DataFrame, order, n: int, percent: int) -> DataFrame:
    """rid, id, k1, k2 (fingerprints of the row's id and text, and its text),
    n, key (of the set), prefix, sketch."""
    src = docs.select(F.monotonically_increasing_id().alias("rid"), "id", "k1", "k2", "text")
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = order.value
        for batch in batches:
            for part in slices(batch, limit=1_000_000):
                row, gram = shingles(Words(part.column(4)), n, True)
                size = np.bincount(row, minlength=part.num_rows)
                begin = np.concatenate([[0], np.cumsum(size)])
                raw = gram.tobytes()
                key = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
                       for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
                gram = gram[np.lexsort((rare.counts(gram), row))]  # stable: equal counts stay by fingerprint
                first = np.where(size >= smallest(percent), np.minimum(size, size - needed(size, percent) + SHARED), 0)
                end = np.cumsum(first)
                at = np.arange(end[-1]) + np.repeat(begin[:-1] - (end - first), first) if len(end) else end
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], end]), pa.int32()),
                                                  pa.array(gram[at].view(np.int64)))
                of = row * SKETCH + (gram & np.uint64(SKETCH - 1)).astype(np.int64)
                counts = np.bincount(of, minlength=part.num_rows * SKETCH).astype(np.uint8)  # modulo 256
                sketch = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(SKETCH), part.num_rows, [None, pa.py_buffer(counts)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), part.column(3), pa.array(size, pa.int64()),
                    pa.array(key, pa.binary()), prefix, sketch],
                    names=["rid", "id", "k1", "k2", "n", "key", "prefix", "sketch"])

    return src.mapInArrow(run, f"rid bigint, id {id_type}, k1 bigint, k2 bigint, n bigint, key binary, "
                               "prefix array<bigint>, sketch binary")


def first_of_classes(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """rid, n, prefix: one row of each class.  Only rows that may be further
    copies, by a filter of those, are looked up."""
    rows = signed.select("rid", "n", "prefix").where(F.size("prefix") > 0)
    copies = signed.where("n > 0").select("rid", "key").join(classes.select("key", "class"), "key").where("rid <> class")
    maybe = bit_filter(copies.select(F.xxhash64("rid").alias("h")))
    first = classes.select(F.col("class").alias("rid"))
    hashed = F.xxhash64("rid")
    return passed(rows, hashed, maybe, "left_anti").unionByName(passed(rows, hashed, maybe).join(first, "rid"))


def prefix_posts(classes: DataFrame, percent: int) -> DataFrame:
    """rid, n, pos, h, size, band: the prefix shingles that several classes
    have, with the number of those, and the class's length band."""
    again = bit_filter(classes.select("prefix"), least=2)
    posts = passed(classes.select("rid", "n", F.posexplode("prefix").alias("pos", "h")), F.col("h"), again)
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    # lookups on aggregates of the same key: a hot shingle is split over tasks
    sizes = posts.groupBy(F.col("h").alias("of")).agg(F.count("*").alias("size")).where("size > 1")
    return written(lookup_join(posts, sizes, ["h"], ["of"], "inner").drop("of").withColumn("band", band), "prefix-posts")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number of shingles by which sets of these sketches differ."""
    d = a - b  # counts are known modulo 256
    return np.minimum(d, -d).sum(-1, dtype=np.int64)


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def candidate_pairs(few: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of classes that may link, of blocks that make pairs."""
    x = few.select("h", F.col("rid").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    y = few.select("h", F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    low, high = F.least("na", "nb"), F.greatest("na", "nb")
    reach = F.least("pa", "pb") + 1 + F.least(F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
    pairs = x.join(y, "h").where((F.col("a") < F.col("b")) & (low * 100 >= high * percent)
                                 & (reach * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))
    pairs = pairs.groupBy("a", "b").count().where(F.col("count") >= SHARED).select("a", "b")
    for end in ("a", "b"):
        of = sketches.select(F.col("rid").alias("of"), F.col("n").alias(f"n{end}"), F.col("sketch").alias(f"s{end}"))
        pairs = lookup_join(pairs, of, [end], ["of"], "inner").drop("of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = batch.column(2).to_numpy(), batch.column(4).to_numpy()
                most = na + nb - 2 * pair_needed(na, nb, percent)
                may = pa.array(_apart(_sketches(batch.column(3)), _sketches(batch.column(5))) <= most)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(may), batch.column(1).filter(may)], ["a", "b"])

    return pairs.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a bigint, b bigint")


def crowd_edges(many: DataFrame, sketches: DataFrame, percent: int, crowd: int) -> DataFrame:
    """(a, b): edges that connect the classes of one block that may link."""
    # sets that link are of the same or of neighbouring bands
    member = many.select("h", F.explode(F.array("band", F.col("band") - 1)).alias("band"), "rid")
    sizes = member.groupBy("h", "band").agg(F.count("*").alias("members"), F.min("rid").alias("lead"))
    named = sizes.where("members > 1").select(F.col("h").alias("of"), F.col("band").alias("of_band"), "members", "lead")
    member = lookup_join(member, named, ["h", "band"], ["of", "of_band"], "inner")
    ties = member.where(F.col("members") > crowd).select(F.col("rid").alias("a"), F.col("lead").alias("b"))
    known = sketches.select(F.col("rid").alias("node"), "n", "sketch")
    small = lookup_join(member.where(F.col("members") <= crowd).select("h", "band", "rid"), known, ["rid"], ["node"], "inner")

    def link(found: pa.Table) -> pa.Table:
        rid, n = found.column("rid").to_numpy(), found.column("n").to_numpy()
        sketch = _sketches(found.column("sketch"))
        left = np.ones(len(rid), bool)
        root = np.arange(len(rid))
        for seed in range(len(rid)):
            if not left[seed]:
                continue
            left[seed] = False
            reached = [seed]
            while reached:
                i = reached.pop()
                rest = np.flatnonzero(left)
                rest = rest[(np.minimum(n[rest], n[i]) * 100 >= np.maximum(n[rest], n[i]) * percent)]
                most = n[rest] + n[i] - 2 * pair_needed(n[rest], n[i], percent)
                rest = rest[_apart(sketch[rest], sketch[i]) <= most]
                left[rest] = False
                root[rest] = seed
                reached.extend(rest.tolist())
        linked = root != np.arange(len(rid))
        return pa.table({"a": rid[linked], "b": rid[root[linked]]})

    return ties.unionByName(small.select("h", "band", "rid", "n", "sketch").groupBy("h", "band").applyInArrow(
        link, "a bigint, b bigint"))


def candidate_edges(shared: DataFrame, sketches: DataFrame, percent: int, block: int, crowd: int) -> DataFrame:
    """(a, b): pairs of classes that may link, and edges that connect the
    members of large blocks that may.  Whatever links is connected."""
    few, many = shared.where(F.col("size") <= block), shared.where(F.col("size") > block)
    return candidate_pairs(few, sketches, percent).unionByName(crowd_edges(many, sketches, percent, crowd)).where(
        "a <> b").distinct()


def _tile_links(sizes: np.ndarray, grams: np.ndarray, side: np.ndarray, cross: bool, percent: int):
    """(x, y) of the linked sets of a tile; of two sides only pairs across.

    The sets are indexed by ascending size; each looks its prefix up among
    the smaller ones before it.
    """
    begin = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, token, count = np.unique(grams, return_inverse=True, return_counts=True)
    # number the shingles rare first, each set in that order
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    token = rank[token]
    token = token[np.lexsort((token, owner))]
    place = np.arange(len(token)) - begin[owner]
    inside = place < (sizes - needed(sizes, percent) + 1)[owner]
    index: dict[int, list[tuple[int, int]]] = {}
    links_x, links_y = [], []
    by_size = np.argsort(sizes, kind="stable")
    prefix_end = begin[:-1] + np.bincount(owner[inside], minlength=len(sizes))
    for x in by_size.tolist():
        n = int(sizes[x])
        least = needed(n, percent)
        met: dict[int, int] = {}
        for at in range(begin[x], prefix_end[x]):
            t, i = int(token[at]), int(at - begin[x])
            posts = index.get(t)
            if posts is None:
                index[t] = [(x, i)]
                continue
            for y, j in posts:
                if y in met or (cross and side[x] == side[y]):
                    continue
                m = int(sizes[y])
                met[y] = 1
                if m < least:  # length
                    continue
                want = pair_needed(n, m, percent)
                if 1 + min(n - i - 1, m - j - 1) < want:  # position: this is their first common shingle
                    continue
                a, b = token[at + 1 : begin[x + 1]], token[begin[y] + j + 1 : begin[y + 1]]
                if _at_most(a, b) + 1 < want:  # suffix
                    continue
                if 1 + _common(a, b) >= want:
                    links_x.append(x)
                    links_y.append(y)
            posts.append((x, i))
    return np.array(links_x, np.int64), np.array(links_y, np.int64)


def _at_most(a: np.ndarray, b: np.ndarray) -> int:
    """A bound on the common shingles of two sorted suffixes: cut both at the
    middle shingle of one; each half holds no more than its smaller part."""
    if not len(a) or not len(b):
        return 0
    middle = a[len(a) // 2]
    i, j = len(a) // 2, int(np.searchsorted(b, middle))
    return min(i, j) + min(len(a) - i, len(b) - j)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> list[int]:
    """Union-find over the n members of a tile."""
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in zip(x.tolist(), y.tolist()):
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.withColumn("k1", F.xxhash64("id", "text")).withColumn("k2", F.xxhash64(F.lit(1), "text"))


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, table: int = 1 << 20, block: int = 64,
                       crowd: int = 2048, tile: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_shingles, component_id (the smallest id it
    reaches by links) and n_links (classes of other texts it links to); with
    k1, k2 (fingerprints of id and text, and of the text) and component (a
    number of the component, null without words)."""
    if needed(smallest(percent), percent) < SHARED:
        raise ValueError("the percentage is too low for the prefix join")
    spark = docs.sparkSession
    src = _keyed(docs, id_col, text_col)
    order = spark.sparkContext.broadcast(Order(*frequent(src, n, table)))  # at most ``table`` entries
    signed = written(signatures(src, order, n, percent), "signatures")
    sets = signed.where("n > 0").groupBy("key").agg(F.min("rid").alias("rid"), F.min("id").alias("low_id"))
    classes = written(sets.select("key", F.col("rid").alias("class"), "low_id"), "classes", rows=signed.count())
    posts = prefix_posts(first_of_classes(signed, classes), percent)
    edges = written(candidate_edges(posts, signed.select("rid", "n", "sketch"), percent, block, crowd), "candidates",
                    rows=posts.count())
    clusters = components(edges)
    linked, degree = _verify(src, signed, clusters, n, percent, tile)
    found = components(linked)
    label = classes.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    lowest = label.groupBy("component").agg(F.min("low_id").alias("component_id"))
    label = label.select("key", "class", "component").join(lowest, "component").join(degree, "class", "left")
    label = label.select("key", "component", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = signed.select("id", "k1", "k2", "n", "key").join(label, "key", "left")
    return out.select("k1", "k2", "component", F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def _verify(src: DataFrame, signed: DataFrame, clusters: DataFrame, n: int, percent: int, tile: int):
    """Edges (a, b) that connect what links, and each class's links."""
    sized = clusters.groupBy("component").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))
    member = clusters.join(sized, "component").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    # the sets again, of the classes in clusters only; a text is found by id and fingerprint
    where = signed.select(F.col("rid").alias("node"), "k1", "k2")
    member = written(member.join(where, "node").dropDuplicates(["k1", "k2"]), "members", rows=signed.count())
    fetched = passed(src.select("k1", "k2", "text"), F.col("k1"), bit_filter(member.select("k1")))
    texts = fetched.dropDuplicates(["k1", "k2"]).join(member, ["k1", "k2"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                row, gram = shingles(Words(part.column(4)), n, True)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), part.column(3),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(gram.view(np.int64)))],
                    names=["node", "component", "chunk", "chunks", "grams"])

    sets = texts.select("node", "component", "chunk", "chunks", "text").mapInArrow(
        whole, "node bigint, component bigint, chunk int, chunks int, grams array<bigint>")
    # a chunk meets itself and every other chunk of its cluster
    tiles = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "component", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        F.col("chunk").alias("side"), "node", "grams")
    schema = "node bigint, root bigint, links bigint"

    def verify(found: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        node = found.column("node").to_numpy()
        lists = found.column("grams").combine_chunks()
        side = found.column("side").to_numpy()
        cross = bool(found.column("i")[0].as_py() != found.column("j")[0].as_py())
        x, y = _tile_links(lists.value_lengths().to_numpy().astype(np.int64),
                           lists.flatten().to_numpy().view(np.uint64), side, cross, percent)
        links = np.bincount(x, minlength=len(node)) + np.bincount(y, minlength=len(node))
        root = node[np.array(_roots(len(node), x, y), np.int64)]
        keep = links > 0
        return pa.table({"node": node[keep], "root": root[keep], "links": links[keep].astype(np.int64)})

    done = written(tiles.groupBy("component", "i", "j").applyInArrow(verify, schema), "links")
    degree = done.groupBy(F.col("node").alias("class")).agg(F.sum("links").alias("n_links"))
    return done.select(F.col("node").alias("a"), F.col("root").alias("b")), degree


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without their near duplicates: of each component the row
    of the smallest id; documents without words all stay."""
    found = jaccard_components(docs, id_col=id_col, text_col=text_col, **options)
    found = written(found.select(F.col(f"`{id_col}`").alias("id"), "k1", "k2", "component"), "found",
                    rows=docs.count())
    groups = found.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull(), F.col("id"), "k1", "k2")).alias("first"))
    chosen = groups.select("first.k1", "first.k2", F.lit(True).alias("once"))
    chosen = chosen.unionByName(found.where(F.col("component").isNull()).select("k1", "k2", F.lit(False).alias("once"))
                                .distinct())
    chosen = written(chosen, "chosen", rows=found.count())
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(row.alias("row"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("k1"),
                       F.xxhash64(F.lit(1), text).alias("k2"))
    # only rows that may go, by a filter of those, are shuffled
    times = found.groupBy("k1", "k2").agg(F.count("*").alias("times")).join(chosen, ["k1", "k2"], "left")
    doubtful = bit_filter(times.where("once IS NULL OR once AND times > 1").select("k1"))
    clear = passed(rows, F.col("k1"), doubtful, "left_anti").select("row")
    # of rows with equal id and text the first by the other columns' hash
    others = [F.col("row").getField(c) for c, t in docs.dtypes if not t.startswith("map")]
    copy = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.xxhash64(*others)))
    kept = passed(rows, F.col("k1"), doubtful).join(chosen, ["k1", "k2"]).withColumn("copy", copy).where(
        "copy = 1 OR NOT once")
    kept = clear.unionByName(kept.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
