"""Substring dedup: repeated-phrase automata.

Removes every word covered by a window of ``window`` consecutive words whose
word sequence also starts anywhere else in the corpus, the same document
included.

1. Seeds.  Every window has a minimizer, its smallest ``seed``-word
   fingerprint (leftmost of equals).  Equal windows have equal minimizers at
   equal offsets, so a repeated window's minimizer recurs.  Counting one
   occurrence per run of windows finds the recurring seeds at a twelfth of
   the words.
2. Pieces.  The windows that share a seed occurrence form a piece of up to
   ``2 * window - seed`` words.  Pieces with recurring seeds are counted by
   content; a piece that occurs twice confirms all its windows, the windows
   of the others are confirmed by counting them over all pieces (by 64 bits
   of content under 64 bits of seed and offset).  Copies collapse into a
   count before anything is shuffled.
3. Automata.  Documents are dealt into shards of bounded bytes by a hash of
   id and text; each shard gets the confirmed pieces that occur in it, as
   fingerprints.  A task spells out its shard's recurring passages (maximal
   runs of confirmed windows), compiles them into Aho-Corasick automata over
   words and streams all documents of the shard through them; what an
   occurrence covers is removed.

Recurring seeds are sent to the tasks as a sorted array of at most
``seed_block`` (8 bytes each); more of them take further passes.

Defined results: a null text has no words; texts shorter than the window
are kept whole; repeated rows are documents of their own, so their windows
recur; a null id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareshift.llm.stage import written
from wareshift.llm.text import Words, _powers, mix, slices

#: Bytes of text in a shard.
SHARD_BYTES = 4_000_000
#: Words of passages in one automaton.
AUTOMATON_WORDS = 1_000_000
_U = np.uint64


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[: len(x) - step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Pieces:
    """The runs of windows of the rows of a text column that share a
    minimizer: ``first`` word, ``count`` of windows, ``seed``, ``offset`` of
    the seed in the first window."""

    def __init__(self, words: Words, window: int, seed: int):
        self.words, self.window = words, window
        self.hashes = words.hashes(1)
        whole = words.whole(window)
        starts = np.flatnonzero(whole)
        if not len(starts):
            self.first = self.count = self.offset = np.zeros(0, np.int64)
            self.seed = np.zeros(0, _U)
            return
        gram = words.grams(self.hashes, seed)
        width = window - seed + 1
        least = _sliding_min(gram, width)[: len(whole)]
        at = np.zeros(len(whole), np.int64)
        for o in range(width - 1, -1, -1):  # the leftmost stays
            hit = np.flatnonzero(gram[o : o + len(whole)] == least)
            at[hit] = hit + o
        place = at[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        begin = np.flatnonzero(new)
        self.count = np.diff(np.append(begin, len(starts)))
        self.first = starts[begin]
        self.offset = place[begin] - self.first
        self.seed = gram[place[begin]]

    def digests(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the content of the given pieces, with their offset."""
        a, b = self.first[some], self.first[some] + self.count[some] + self.window - 1
        out = []
        for h in (self.hashes, self.words.hashes(2)):
            power, inverse = _powers(0xD6E8FEB86659FD93 | 1, len(h))
            total = np.zeros(len(h) + 1, _U)
            np.cumsum(h * power[: len(h)], dtype=_U, out=total[1:])
            out.append(mix((total[b] - total[a]) * inverse[a] + (self.offset[some] * 64 + self.count[some]).astype(_U)))
        return out[0].view(np.int64), out[1].view(np.int64)


def _among(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _count_seeds(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                h, n = np.unique(Pieces(Words(part.column(1)), window, seed).seed, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return run


def _piece_rows(window: int, seed: int, seeds):
    """The distinct pieces of a slice, with their windows' digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recurring = seeds.value
        for batch in batches:
            for part in slices(batch, limit=8_000_000):
                p = Pieces(Words(part.column(1)), window, seed)
                some = np.flatnonzero(_among(recurring, p.seed))
                if not len(some):
                    continue
                d1, d2 = p.digests(some)
                first, n = _unique_pairs(d1, d2)
                some = some[first]
                gram = p.words.grams(p.words.hashes(2), window)
                size = p.count[some]
                end = np.cumsum(size)
                at = np.arange(end[-1]) + np.repeat(p.first[some] - (end - size), size)
                wins = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], end]), pa.int32()),
                                                pa.array(gram[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(d1[first]), pa.array(d2[first]), pa.array(p.seed[some].view(np.int64)),
                    pa.array(p.offset[some]), wins, pa.array(n)], names=["d1", "d2", "seed", "offset", "wins", "n"])

    return run


def _unique_pairs(d1: np.ndarray, d2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A first index of each distinct pair, and how often it occurs."""
    order = np.lexsort((d2, d1))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(d1[order]) != 0) | (np.diff(d2[order]) != 0)
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _piece_places(window: int, seed: int, seeds):
    """(shard, d1, d2) of the recurring pieces of each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recurring = seeds.value
        for batch in batches:
            for part in slices(batch):
                p = Pieces(Words(part.column(1)), window, seed)
                some = np.flatnonzero(_among(recurring, p.seed))
                shard = part.column(0).to_numpy()[p.words.row[p.first[some]]]
                d1, d2 = p.digests(some)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(d1), pa.array(d2)], names=["shard", "d1", "d2"])

    return run


def _parts(first: int, last: int, window: int) -> Iterator[tuple[int, int]]:
    """A passage (word range) in parts that one automaton can spell.  They
    overlap by window - 1 words, so every window lies in some part; a part
    holds windows of the passage only, so it covers nothing else."""
    step = max(1, AUTOMATON_WORDS - window + 1)
    for at in range(first, max(first + 1, last - window + 1), step):
        yield at, min(last, at + step + window - 1)


def covered(words: Words, passages: list[tuple[int, int]]) -> np.ndarray:
    """Which words the occurrences of the passages (word ranges) cover.

    The passages, of at most AUTOMATON_WORDS words each, are compiled into
    automata over word numbers, each of at most AUTOMATON_WORDS words in all;
    words of no passage are one symbol.
    """
    import ahocorasick

    out = np.zeros(len(words) + 1, np.int64)
    if not passages:
        return out[:-1] > 0
    one, other = words.hashes(1), words.hashes(2)
    at = 0
    while at < len(passages):
        size, to = 0, at
        while to < len(passages) and (to == at or size + passages[to][1] - passages[to][0] <= AUTOMATON_WORDS):
            size += passages[to][1] - passages[to][0]
            to += 1
        used = np.concatenate([np.arange(a, b) for a, b in passages[at:to]])
        key, first = np.unique(one[used], return_index=True)
        if len(key) > 1_100_000:
            raise ValueError("a passage of more than 1,100,000 different words")
        number = np.searchsorted(key, one)
        found = (number < len(key)) & (key[np.minimum(number, len(key) - 1)] == one)
        number = np.minimum(number, len(key) - 1)
        found &= other[used[first]][number] == other  # both fingerprints: 128 bits a word
        symbol = np.where(found, number + 2, 1)
        symbol += np.where(symbol >= 0xD800, 0x800, 0)  # past the surrogates
        spelled = symbol.astype("<u4").tobytes()

        def text(a: int, b: int, spelled: bytes = spelled) -> str:
            return spelled[4 * a : 4 * b].decode("utf-32-le")

        automaton = ahocorasick.Automaton()
        for a, b in passages[at:to]:
            automaton.add_word(text(a, b), b - a)
        automaton.make_automaton()
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if b > a and found[a:b].any():
                for end, size in automaton.iter(text(a, b)):
                    out[a + end + 1 - size] += 1
                    out[a + end + 1] -= 1
        at = to
    return np.cumsum(out[:-1]) > 0


def _shard_cover(words: Words, window: int, seed: int, d1: np.ndarray, d2: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which words of a shard are removed, given its confirmed pieces."""
    if not len(d1) or not len(words):
        return np.zeros(len(words), bool)
    p = Pieces(words, window, seed)
    a, b = p.digests(np.arange(len(p.first)))
    order = np.argsort(d1, kind="stable")
    d1, d2, mask = d1[order], d2[order], mask[order]
    at = np.minimum(np.searchsorted(d1, a), len(d1) - 1)
    known = np.flatnonzero((d1[at] == a) & (d2[at] == b))
    bits = mask[at[known]]
    size = p.count[known]
    end = np.cumsum(size)
    if not len(known):
        return np.zeros(len(words), bool)
    step = np.arange(end[-1]) - np.repeat(end - size, size)
    start = (np.repeat(p.first[known], size) + step)[(np.repeat(bits, size) >> step) & 1 == 1]
    if not len(start):
        return np.zeros(len(words), bool)
    # passages: maximal runs of confirmed windows of one document
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (words.row[start[1:]] != words.row[start[:-1]])
    first = start[new]
    last = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1] + window
    passages = {}
    raw = p.hashes
    for whole in zip(first.tolist(), last.tolist()):
        for f, t in _parts(*whole, window):
            passages.setdefault(raw[f:t].tobytes(), (f, t))
    return covered(words, sorted(passages.values()))


def remove_repeats(docs: DataFrame, window: int = 35, seed: int = 12, seed_block: int = 4_000_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed and kept (the words left, joined by a space)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    total = src.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    shards = max(1, -(-total // SHARD_BYTES))
    placed = src.select(F.pmod(F.xxhash64("id", "text"), F.lit(shards)).alias("shard"), "text")
    recurring = written(
        placed.mapInArrow(_count_seeds(window, seed), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
        .where("n > 1").select("h"), "seeds")
    blocks = max(1, -(-recurring.count() // seed_block))
    pieces = places = None
    for block in range(blocks):
        some = recurring.where(F.pmod(F.xxhash64("h"), F.lit(blocks)) == block) if blocks > 1 else recurring
        # at most seed_block fingerprints, give or take the hash
        seeds = spark.sparkContext.broadcast(np.sort(some.toArrow().column("h").to_numpy().view(_U)))
        p = placed.mapInArrow(_piece_rows(window, seed, seeds),
                              "d1 bigint, d2 bigint, seed bigint, offset bigint, wins array<bigint>, n bigint")
        q = placed.mapInArrow(_piece_places(window, seed, seeds), "shard bigint, d1 bigint, d2 bigint")
        pieces, places = (p, q) if pieces is None else (pieces.unionByName(p), places.unionByName(q))
    pieces = written(
        pieces.groupBy("d1", "d2").agg(F.sum("n").alias("n"), F.first("seed").alias("seed"),
                                       F.first("offset").alias("offset"), F.first("wins").alias("wins"))
        .withColumn("piece", F.monotonically_increasing_id()), "pieces")
    # a window is the same as another if seed, offset and content are
    windows = pieces.select("piece", "n", "seed", "offset", F.posexplode("wins").alias("i", "k2")).select(
        "piece", "n", "i", "k2", F.xxhash64("seed", F.col("offset") - F.col("i")).alias("k1"))
    twice = windows.groupBy("k1", "k2").agg(F.sum("n").alias("n")).where("n > 1").select("k1", "k2")
    confirmed = (windows.where("n = 1").select("piece", "i", "k1", "k2").join(twice, ["k1", "k2"])
                 .groupBy("piece").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask")))
    verdict = pieces.select("piece", "d1", "d2", "n").join(confirmed, "piece", "left").select(
        "d1", "d2", F.when(F.col("n") > 1, F.lit(-1).cast("bigint")).otherwise(F.col("mask")).alias("mask"))
    verdict = written(verdict.where(F.col("mask").isNotNull()), "confirmed")
    sent = places.join(verdict, ["d1", "d2"])
    id_type = src.schema["id"].dataType.simpleString()

    def cut(found: pa.Table, known: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        words = Words(found.column("text"))
        gone = _shard_cover(words, window, seed, *(known.column(c).to_numpy() for c in ("d1", "d2", "mask")))
        removed = np.add.reduceat(np.append(gone, False), np.minimum(words.first[:-1], len(gone))) * (words.counts > 0)
        raw = words.data.tobytes()
        kept = []
        for i, (a, b) in enumerate(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())):
            each = raw[a:b].split()
            if removed[i]:
                each = compress(each, (~gone[words.first[i] : words.first[i + 1]]).tolist())
            kept.append(b" ".join(each))
        return pa.table({"id": found.column("id"), "n_words": pa.array(words.counts, pa.int64()),
                         "n_removed": pa.array(removed.astype(np.int64), pa.int64()),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    dealt = src.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)))
    out = dealt.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(
        cut, f"id {id_type}, n_words bigint, n_removed bigint, kept string")
    return out.withColumnRenamed("id", id_col)
