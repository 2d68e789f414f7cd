"""Token counts by rank-synchronous array merging.

Counts the tokens that a byte-fallback BPE model (a sentencepiece
``.model`` file) gives a text, without calling the library per text.  A
slice of texts is one flat array of symbols, cut where no piece of the
vocabulary spans two neighbouring characters: no merge crosses such a cut,
so the cuts give short independent sequences ("pre-tokens").  Equal
sequences of a slice are counted once.  Each round applies, in every
sequence at once, that sequence's lowest-rank pair; the symbols that
survive are the tokens, and a symbol outside the vocabulary counts its
UTF-8 bytes.

Long sequences take the lowest pair of a sliding neighbourhood of the
longest piece's length on either side instead of the whole sequence's: a
merge can only be pre-empted by pieces that reach it, which lie inside.

Defined results: a null text is empty; an empty text has no tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = 0x2581  # the model's mark for a space
_NONE = np.int32(2**31 - 1)
#: Characters of text merged at once; longer texts are cut before a space.
CHUNK_CHARS = 500_000
#: Remembered sequences (25 bytes each) as a power of two.
CACHE_BITS = 20
#: Sequences above this many symbols use the sliding neighbourhood.
LONG = 64

_PROBES = ("The quick  brown fox", "ﬁ ｆｉ é é Å", "\t\n x\r\n", "a​b c", "  ", "日本語 한국어 🙂", "a" * 40)


class PieceMerges:
    """The merge tables of one sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        score = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
        mark = chr(_SPACE)
        runs = {len(p) for p in score if len(p) > 1 and set(p) == {mark}}
        merged = [p for p in score if len(p) > 1 and set(p) != {mark}]
        if any(mark in p[1:] for p in merged):
            raise ValueError("pieces that hold a space mark inside are not supported")
        merged.sort(key=lambda p: -score[p])
        if len({score[p] for p in merged}) != len(merged) or (
                runs and merged and max(score[mark * k] for k in runs) >= score[merged[-1]]):
            raise ValueError("pieces need distinct scores, above those of space runs")
        chars = sorted({c for p in score for c in p})
        ids = {c: i for i, c in enumerate(chars)}
        for rank, p in enumerate(merged):
            ids[p] = len(chars) + rank
        #: symbol id of a merged piece = first_merged + rank
        self.first_merged = len(chars)
        self.longest = max(map(len, merged), default=1)
        #: longest run of space marks that is a piece, and the tokens of shorter runs
        self.run = max(runs, default=1)
        self.run_tokens = np.array([_run_tokens(k, runs) for k in range(self.run + 1)], np.int64)
        if any(_run_tokens(k, runs) != k // self.run + self.run_tokens[k % self.run] for k in range(3 * self.run)):
            raise ValueError("runs of spaces do not fill up from the left")
        pairs = sorted((ids[p[:j]] << 32 | ids[p[j:]], rank) for rank, p in enumerate(merged)
                       for j in range(1, len(p)) if p[:j] in ids and p[j:] in ids)
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int32)
        self.table_bits = max(16, int(np.ceil(np.log2(8 * max(1, len(pairs))))))
        self._fill_table()
        self.char_id = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.char_id[ord(c)] = ids[c]
        bigrams = np.unique(np.array([ids[a] << 32 | ids[b] for p in merged for a, b in zip(p, p[1:])], np.int64))
        self.bigrams = np.zeros((len(chars) * len(chars) + 7) // 8, np.uint8)
        flat = (bigrams >> 32) * len(chars) + (bigrams & 0xFFFFFFFF)
        np.bitwise_or.at(self.bigrams, flat >> 3, (1 << (flat & 7)).astype(np.uint8))
        self.char_cost = np.ones(len(chars), np.int64)  # tokens of a char that stays single
        for c in chars:
            if c not in score:
                self.char_cost[ids[c]] = len(c.encode())
        self.cache_key = np.zeros(1 << CACHE_BITS, np.uint64)
        self.cache_size = np.zeros(1 << CACHE_BITS, np.int64)  # 0: no entry
        self.cache_tokens = np.zeros(1 << CACHE_BITS, np.int64)
        self.cache_alone = np.zeros(1 << CACHE_BITS, bool)
        for probe in _PROBES:
            if self.count([probe])[0] != len(sp.encode(probe)):
                raise ValueError("the model's normalisation is not the identity with a leading space")

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.table_bits)).astype(np.int64)

    def _fill_table(self) -> None:
        """An open-addressing table of the pairs, probed for all pairs at once."""
        n = 1 << self.table_bits
        self.slot_key = np.full(n, -1, np.int64)
        self.slot_rank = np.full(n, _NONE, np.int32)
        left = np.arange(len(self.pair_keys))
        at = self._slot(self.pair_keys)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.slot_key[at] == -1
            first = np.zeros(len(left), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.slot_key[at[put]] = self.pair_keys[left[put]]
            self.slot_rank[at[put]] = self.pair_ranks[left[put]]
            left, at = left[~put], (at[~put] + 1) & (n - 1)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging neighbours, or _NONE."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = self._slot(key)
        found = self.slot_key[at]
        rank = np.where(found == key, self.slot_rank[at], _NONE)
        todo = np.flatnonzero((found != key) & (found != -1))
        mask = (1 << self.table_bits) - 1
        slot = at[todo]
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            slot = (slot + 1) & mask
            found = self.slot_key[slot]
            hit = found == key[todo]
            rank[todo[hit]] = self.slot_rank[slot[hit]]
            stay = ~hit & (found != -1)
            todo, slot = todo[stay], slot[stay]
        return rank

    def merge(self, sym: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each sequence, and whether its first symbol stayed the
        single character it was.  ``sym``: the symbols of all sequences one
        after another; ``lens``: their lengths (at least 1)."""
        tokens = np.zeros(len(lens), np.int64)
        alone = np.zeros(len(lens), bool)
        live = np.arange(len(lens))
        begin = np.concatenate([[0], np.cumsum(lens)[:-1]])
        head = sym[begin]
        seq = np.repeat(np.arange(len(lens)), lens)
        rank = np.full(len(sym), _NONE, np.int32)
        inner = np.flatnonzero(seq[1:] == seq[:-1])
        rank[inner] = self.pair_rank(sym[inner], sym[inner + 1])
        while len(live):
            best = np.minimum.reduceat(rank, begin)
            done = best == _NONE
            if done.any():
                cost = np.where(sym < self.first_merged, self.char_cost[np.minimum(sym, self.first_merged - 1)], 1)
                total = np.add.reduceat(cost, begin)
                tokens[live[done]] = total[done]
                alone[live[done]] = sym[begin[done]] == head[live[done]]
                sizes = np.diff(np.append(begin, len(sym)))
                stay = np.repeat(~done, sizes)
                sym, rank = sym[stay], rank[stay]
                live, best, sizes = live[~done], best[~done], sizes[~done]
                if not len(live):
                    break
                begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            sizes = np.diff(np.append(begin, len(sym)))
            low = np.repeat(best, sizes)
            long = sizes.max() > LONG
            if long:
                low = np.where(np.repeat(sizes > LONG, sizes), _around(rank, self.longest), low)
            hit = np.flatnonzero(rank == low)
            if long:
                hit = hit[rank[hit] != _NONE]
            if long or (np.diff(hit) == 1).any():
                hit = self._leftmost(rank, hit)
            sym[hit] = self.first_merged + rank[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            of = np.searchsorted(begin, hit, side="right") - 1  # their sequences
            sizes = sizes - np.bincount(of, minlength=len(begin))
            sym, rank = sym[keep], rank[keep]
            begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hit = hit - np.arange(len(hit))
            last = hit == begin[of] + sizes[of] - 1
            rank[hit[last]] = _NONE
            redo = np.concatenate([hit[~last], hit[hit != begin[of]] - 1])
            rank[redo] = self.pair_rank(sym[redo], sym[redo + 1])
        return tokens, alone

    def _cached(self, sym: np.ndarray, begin: np.ndarray, size: np.ndarray,
                key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """merge(), remembering results under 64-bit fingerprints in a table
        of fixed size (a later sequence takes an earlier one's place)."""
        slot = (key >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        tokens, alone = self.cache_tokens[slot], self.cache_alone[slot]
        new = np.flatnonzero((self.cache_key[slot] != key) | (self.cache_size[slot] != size))
        if len(new):
            flat = _ragged(begin[new], size[new])
            tokens[new], alone[new] = self.merge(sym[flat], size[new])
            slot = slot[new]
            self.cache_key[slot], self.cache_size[slot] = key[new], size[new]
            self.cache_tokens[slot], self.cache_alone[slot] = tokens[new], alone[new]
            # of sequences that share a slot the last one's fields stay, all four
        return tokens, alone

    @staticmethod
    def _leftmost(rank: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Of overlapping equal pairs take every other one from the left."""
        n = len(rank)
        hit = np.zeros(n, bool)
        hit[hits] = True
        same = np.zeros(n, bool)
        same[1:] = (rank[1:] == rank[:-1]) & (rank[1:] != _NONE)
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(same, 0, at))
        return np.flatnonzero(hit & hit[start] & ((at - start) % 2 == 0))

    def _spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether some piece holds characters a, b in a row."""
        ok = (a >= 0) & (b >= 0)
        flat = np.where(ok, a.astype(np.int64) * self.first_merged + b, 0)
        return ok & ((self.bigrams[flat >> 3] >> (flat & 7).astype(np.uint8)) & 1).astype(bool)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        part: list[str] = []
        of: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in _cut(" " + text if text else ""):
                part.append(piece)
                of.append(i)
                size += len(piece)
                if size >= CHUNK_CHARS:
                    np.add.at(out, of, self._count(part))
                    part, of, size = [], [], 0
        if part:
            np.add.at(out, of, self._count(part))
        return out

    def _count(self, parts: list[str]) -> np.ndarray:
        lens = np.array([len(p) for p in parts], np.int64)
        code = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
        code = np.where(code == 32, _SPACE, code)
        part_of = np.repeat(np.arange(len(parts)), lens)
        sym = self.char_id[code]
        out = np.zeros(len(parts), np.int64)
        lost = sym < 0  # outside the vocabulary: one token per UTF-8 byte
        if lost.any():
            c = code[lost]
            out += np.bincount(part_of[lost], 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), len(parts)).astype(np.int64)
        joined = np.zeros(len(sym), bool)  # with the symbol before it
        joined[1:] = self._spans(sym[:-1], sym[1:]) & (part_of[1:] == part_of[:-1])
        begin = np.flatnonzero(~joined)
        size = np.diff(np.append(begin, len(sym)))
        known = sym[begin] >= 0
        lone = known & (size == 1) & (code[begin] != _SPACE)
        if lone.any():
            at = begin[lone]
            out += np.bincount(part_of[at], self.char_cost[sym[at]], len(parts)).astype(np.int64)
        seqs = known & ((size > 1) | (code[begin] == _SPACE))
        begin, size = begin[seqs], size[seqs]
        if not len(begin):
            return out
        which, first, key = _distinct(sym, begin, size)
        tokens, alone = self._cached(sym, begin[first], size[first], key)
        spaced = code[begin] == _SPACE
        single = spaced & alone[which]  # the space mark joined nothing
        out += np.bincount(part_of[begin], tokens[which] - single, len(parts)).astype(np.int64)
        # unjoined marks in a row become runs, greedily from the left
        at = begin[single]
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (part_of[at[1:]] != part_of[at[:-1]])
            heads = np.flatnonzero(new)
            length = np.diff(np.append(heads, len(at)))
            runs = length // self.run + self.run_tokens[length % self.run]
            out += np.bincount(part_of[at[heads]], runs, len(parts)).astype(np.int64)
        return out


def _run_tokens(k: int, lengths: set[int]) -> int:
    """Tokens of k space marks: all runs score alike, so the leftmost pair
    that makes a piece merges first."""
    marks = [1] * k
    while True:
        at = next((i for i in range(len(marks) - 1) if marks[i] + marks[i + 1] in lengths), None)
        if at is None:
            return len(marks)
        marks[at : at + 2] = [marks[at] + marks[at + 1]]


def _around(rank: np.ndarray, radius: int) -> np.ndarray:
    """Minimum over the positions within ``radius`` on either side."""
    width = 2 * radius + 1
    pad = np.full(len(rank) + 2 * radius, _NONE, rank.dtype)
    pad[radius : radius + len(rank)] = rank
    step = 1
    while 2 * step <= width:
        pad = np.minimum(pad[: len(pad) - step], pad[step:])
        step *= 2
    rest = width - step
    return np.minimum(pad[: len(pad) - rest], pad[rest:]) if rest else pad


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes begin[i] .. begin[i]+size[i]-1, one run after another."""
    total = np.cumsum(size)
    return np.arange(total[-1]) + np.repeat(begin - (total - size), size)


def _distinct(sym: np.ndarray, begin: np.ndarray,
              size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number the distinct sequences; index of a first one of each, and its
    fingerprint.  Sequences
    of equal fingerprint are compared symbol by symbol."""
    from wareshift.llm.text import _powers, mix

    power, inverse = _powers(0xD6E8FEB86659FD93 | 1, len(sym))
    total = np.zeros(len(sym) + 1, np.uint64)
    np.cumsum(mix(sym.astype(np.uint64)) * power[: len(sym)], dtype=np.uint64, out=total[1:])
    key = mix((total[begin + size] - total[begin]) * inverse[begin])
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    other = size != size[first[which]]
    flat = _ragged(begin, np.where(other, 1, size))
    twin = _ragged(begin[first[which]], np.where(other, 1, size))
    heads = np.concatenate([[0], np.cumsum(np.where(other, 1, size))[:-1]])
    other |= np.logical_or.reduceat(sym[flat] != sym[twin], heads)
    if other.any():  # a clash of fingerprints: a sequence of its own
        at = np.flatnonzero(other)
        which = which.copy()
        which[at] = len(first) + np.arange(len(at))
        first = np.concatenate([first, at])
    return which, first, key[first]


def _cut(text: str) -> Iterator[str]:
    """Parts of a long text, cut before a space that follows another
    character (no piece spans that place)."""
    at = 0
    while len(text) - at > CHUNK_CHARS:
        to = at + CHUNK_CHARS
        while True:
            to = text.find(" ", to)
            if to < 0 or text[to - 1] != " ":
                break
            to += 1
        if to < 0:
            break
        yield text[at:to]
        at = to
    if len(text) > at:
        yield text[at:]


_MERGES: dict[str, PieceMerges] = {}


def merges(path: str) -> PieceMerges:
    """The tables of a model, loaded once per worker."""
    if path not in _MERGES:
        _MERGES[path] = PieceMerges(path)
    return _MERGES[path]


def token_counts(docs: DataFrame, model_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit (n_tokens > limit) per row.

    A map over the scan: nothing is shuffled; repeated rows give repeated
    results, a null id stays null, other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            model = model or merges(model_path)
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                n = model.count(texts)
                size = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["id", "n_bytes", "n_tokens"])

    out = src.mapInArrow(run, f"id {id_type.simpleString()}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
