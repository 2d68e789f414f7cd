"""Word and n-gram fingerprints of whole texts, computed on the Arrow
buffers with numpy.

A word is a maximal run of bytes other than space and TAB..CR (the UTF-8
bytes of ``[^\\x20\\x09-\\x0D]+``).  Fingerprints are polynomial hashes
modulo 2**64 over per-byte random values, finished with a 64-bit mixer;
they are the same in every task, on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM_BASE = 0xD6E8FEB86659FD93 | 1
_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
#: Separators that leave letters and digits: all other ASCII.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

#: Bytes of text that one slice of a batch holds (a longer document is a
#: slice of its own).
SLICE_BYTES = 2_000_000
#: Bytes of text hashed at once; bounds the temporaries of a long document.
_BLOCK = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (xor-shift, multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values(seed: int, fold_case: bool) -> np.ndarray:
    at = np.arange(256, dtype=_U)
    if fold_case:
        at[65:91] += _U(32)
    out = mix(at + _U(seed) * _U(1_000_003) + _U(7)) | _U(1)
    out[_WS] = 0  # separators add nothing to the sum of the word before them
    return out


_VALUES = {(seed, fold): _byte_values(seed, fold) for seed in (1, 2) for fold in (False, True)}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, _U)
            p[0] = 1
            both.append(np.cumprod(p, dtype=_U))
        have = (both[0], both[1])
        if n <= 4 * _BLOCK:
            _POWERS[base] = have
    return have


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (a null is
    an empty text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of text."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = max(first + 1, min(last, batch.num_rows))
        yield batch.slice(first, last - first)
        first = last


class Words:
    """The words of the rows of a string column.

    ``start``/``end`` are byte positions in ``data``; ``row`` is each word's
    row; ``first`` holds, for each row and one past the last, the index of
    its first word.
    """

    def __init__(self, column: pa.Array, separators: np.ndarray = _WS):
        self.data, self.offsets = text_bytes(column)
        n = len(self.data)
        inside = ~separators[self.data]
        if separators is not _WS:
            self.data = np.where(inside, self.data, np.uint8(32))
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cut = self.offsets[:-1][np.diff(self.offsets) > 0]
        begins[cut] = inside[cut]
        cut = cut[cut > 0] - 1
        ends[cut] = inside[cut]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        assert n == 0 or len(self.start) == len(self.end)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 1, fold_case: bool = False) -> np.ndarray:
        """One 64-bit fingerprint per word; ``fold_case`` reads A-Z as a-z."""
        return segment_hashes(self.data, self.start, self.end, seed, fold_case)

    def grams(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the n words from each position on; positions whose
        n words do not lie in one row are meaningless (see ``whole``)."""
        m = len(hashes) - n + 1
        if m <= 0:
            return np.zeros(0, _U)
        power, inverse = _powers(_GRAM_BASE, len(hashes))
        total = np.zeros(len(hashes) + 1, _U)
        np.cumsum(hashes * power[: len(hashes)], dtype=_U, out=total[1:])
        return mix((total[n:] - total[:-n]) * inverse[:m])

    def whole(self, n: int) -> np.ndarray:
        """Which positions start n words of one row."""
        m = len(self) - n + 1
        if m <= 0:
            return np.zeros(0, bool)
        return self.row[:m] == self.row[n - 1 :]


def segment_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1,
                   fold_case: bool = False) -> np.ndarray:
    """One 64-bit fingerprint per segment; only separators may lie between
    segments."""
    values = _VALUES[seed, fold_case]
    out = np.zeros(len(start), _U)
    at = 0
    while at < len(start):
        to = max(int(np.searchsorted(start, start[at] + _BLOCK)), at + 1)
        lo, hi = start[at], end[to - 1]
        power, inverse = _powers(_BASE, int(hi - lo))
        begins = start[at:to] - lo
        out[at:to] = np.add.reduceat(values[data[lo:hi]] * power[: hi - lo], begins) * inverse[begins]
        at = to
    return mix(out)


def shingles(words: Words, n: int, fold_case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-word shingles of each row as (row, fingerprint), sorted
    by row and fingerprint.  A row with fewer words has one shingle, all its
    words; a row without words has none."""
    h = words.hashes(fold_case=fold_case)
    keep = words.whole(n)
    row = words.row[: len(keep)][keep]
    gram = words.grams(h, n)[keep]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        extra = np.zeros(len(short), _U)
        for size in range(1, n):
            of = np.flatnonzero(words.counts[short] == size)
            if len(of):
                # another length must give another fingerprint
                extra[of] = mix(words.grams(h, size)[words.first[short[of]]] + _U(size))
        row, gram = np.concatenate([row, short]), np.concatenate([gram, extra])
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    if len(row):
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        row, gram = row[new], gram[new]
    return row, gram
