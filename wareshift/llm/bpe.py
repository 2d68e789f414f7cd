"""BPE encoding and decoding with forced boundaries.

A byte-level BPE model builds every token out of neighbouring bytes, so two
bytes that never stand side by side inside any token of the vocabulary are
never joined: between them lies a certain cut.  The pairs are tabulated once
from the vocabulary (a word's last byte is a symbol of its own where the
model marks word ends), every piece of the text falls into fragments at its
certain cuts, each distinct fragment is encoded once by itself, and the ids
are laid one after another.  No merge crosses a cut, and within a fragment
the merges apply in the same order as within the piece, so the ids are those
of the whole text.

The map is narrow: nothing is shuffled, a worker remembers fragments in
arrays of fixed size, and a slice of texts is bounded by its bytes (a longer
document is a slice of its own).

Defined results: a null text is an empty text, without ids, and decodes to
the empty text; strings of special tokens become those tokens, as the
library does by default; repeated rows give repeated results; null ids stay
null; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.llm.idtable import IdTable, ragged
from wareshift.llm.text import Words, segment_hashes, slices
from wareshift.llm.token_ids import Units, _byte_letters, _whole_words

#: Bytes of text encoded together.
SLICE_BYTES = 2_000_000

_PROBES = ("Hello a1b22,,c Éàß--x ÀÖØÞ tion.***", "(~) x_y 2024-01-01 straße; it's 'tis x×y", " a\n\tB ", "", "日本 é́",
           "q" * 30 + "zx" * 20)


class ForcedBoundaries:
    """The certain cuts of a vocabulary.

    ``joined[a, b]``: byte b follows byte a inside some token; columns from
    256 on stand for a byte that ends a word (``suffix`` after it)."""

    def __init__(self, vocabulary: list[str], suffix: str):
        byte_of = {chr(c): b for b, c in _letters().items()}
        self.joined = np.zeros((256, 512), bool)
        self.shift = 256 if suffix else 0  # without marks a last byte is like any other
        for token in vocabulary:
            ends = bool(suffix) and token.endswith(suffix) and len(token) > len(suffix)
            symbols = [byte_of.get(c) for c in (token[: -len(suffix)] if ends else token)]
            if None in symbols:
                continue  # holds a character no byte is spelled with: never produced
            if ends:
                symbols[-1] += 256
            for a, b in zip(symbols, symbols[1:]):
                self.joined[a, b] = True

    def cuts(self, data: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether a certain cut lies before each byte but the first;
        ``last`` marks the bytes that end their word."""
        return ~self.joined[data[:-1], data[1:].astype(np.int64) + self.shift * last[1:]]


def _letters() -> dict[int, int]:
    """Code point that spells each byte."""
    return {**{b: b for b in (*range(33, 127), *range(161, 173), *range(174, 256))}, **_byte_letters()}


class FragmentEncoder:
    """Ids of whole texts from a ``tokenizers`` file with a byte-level BPE
    model.

    ``by_word``: the tokenizer drops white space and never joins across it,
    so texts are taken apart on their bytes: words of ASCII and À-ÿ fall into
    pieces by arrays (``Units``), any other word is normalised and cut into
    pieces by the library.  Otherwise the library cuts every text into
    pieces.  Either way the pieces fall into fragments at the certain cuts.
    """

    def __init__(self, path: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE model without dropout and subword prefix is expected")
        letters = _letters()
        suffix = model.get("end_of_word_suffix") or ""
        missing = [b for b in range(256) if chr(letters[b]) not in model["vocab"]
                   or (suffix and chr(letters[b]) + suffix not in model["vocab"])]
        if missing:
            raise ValueError(f"not a byte-level vocabulary: no token for bytes {missing[:5]}")
        self.tokenizer = Tokenizer.from_file(path)
        self.ending = self.tokenizer.model
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: the same merges for fragments that do not end a word
        self.inner = models.BPE(vocab=model["vocab"], merges=merges) if suffix else self.ending
        self.boundaries = ForcedBoundaries(list(model["vocab"]), suffix)
        self.spelling = np.array([letters[b] for b in range(256)], np.uint32)
        self.byte_of = {chr(c): b for b, c in letters.items()}
        added = self.tokenizer.get_added_tokens_decoder()
        self.special_ids = {t.content: i for i, t in added.items()}
        self.specials = list(self.special_ids)
        plain_added = all(not (t.normalized or t.single_word or t.lstrip or t.rstrip) for t in added.values())
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") \
            if self.specials else None
        if not plain_added:
            raise ValueError("added tokens that match normalised text or strip spaces are not supported")
        self.by_word = by_word
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known = IdTable(self.dtype)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.numbers = [str(i) for i in range(size)]
        self.plain = by_word
        self.plain = by_word and self._agrees()

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and each row's number of ids."""
        if not self.by_word:
            rows = [self._pieced(t or "") for t in column.to_pylist()]
            return np.concatenate([np.zeros(0, self.dtype), *rows]), np.array([len(r) for r in rows], np.int64)
        words = Words(column)
        if not len(words):
            return np.zeros(0, self.dtype), np.zeros(len(column), np.int64)
        units = Units(words, self.specials) if self.plain else _whole_words(words)
        data, start, end, odd = self._fragments(units)
        flat, begin, size = self._distinct(data, start, end, odd)
        total = np.cumsum(size)
        at = np.searchsorted(start, words.offsets)
        return flat[ragged(begin, size)], np.diff(np.concatenate([[0], total])[at])

    def _fragments(self, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cut the units at the certain cuts: bytes, starts, ends, and kinds
        (0 inside a word, 1 ends its word, 2 a word for the library)."""
        data, start, end = units.data, units.start, units.end
        last = np.zeros(len(data), bool)
        last[end - 1] = True
        cut = np.zeros(len(data), bool)
        cut[1:] = self.boundaries.cuts(data, last)
        inside = np.zeros(len(data) + 1, np.int32)  # cuts count inside plain units only
        plain = ~units.odd
        inside[start[plain] + 1] += 1
        inside[end[plain]] -= 1
        cut &= np.cumsum(inside[:-1]) > 0
        first = cut
        first[start] = True
        begins = np.flatnonzero(first)
        unit = np.searchsorted(start, begins, side="right") - 1
        ends = np.minimum(np.append(begins[1:], len(data)), end[unit])
        return data, begins, ends, np.where(units.odd[unit], 2, ends == end[unit])

    def _distinct(self, data, start, end, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, begin, size) of each fragment's ids, each distinct one
        encoded once."""
        tag = kind.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        key = segment_hashes(data, start, end, 1) ^ tag
        other = segment_hashes(data, start, end, 2) ^ tag
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        clash = np.flatnonzero(other != other[first[which]])
        if len(clash):  # equal first fingerprints of different fragments
            which[clash] = len(first) + np.arange(len(clash))
            first = np.concatenate([first, clash])
        raw = data.tobytes()

        def compute(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = first[new]
            found = [self._pieced(raw[a:b].decode()) if k == 2 else self._fragment(raw[a:b], k)
                     for a, b, k in zip(start[at].tolist(), end[at].tolist(), kind[at].tolist())]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.frombuffer(b"".join(f.tobytes() for f in found), self.dtype), sizes

        flat, begin, size = self.known.ids(key[first], other[first], compute)
        return flat, begin[which], size[which]

    def _fragment(self, raw: bytes, ends_word: bool) -> array:
        spelled = self.spelling[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-32-le") if not raw.isascii() \
            else raw.decode()
        return array(self.code, [t.id for t in (self.ending if ends_word else self.inner).tokenize(spelled)])

    def _pieced(self, text: str) -> array:
        """Ids of a text whose pieces the library finds."""
        out = array(self.code)
        for part in self.special.split(text) if self.special else [text]:
            if not part:
                continue
            if part in self.special_ids:
                out.append(self.special_ids[part])
                continue
            if self.tokenizer.normalizer is not None:
                part = self.tokenizer.normalizer.normalize_str(part)
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                raw = np.array([self.byte_of[c] for c in piece], np.uint8)
                last = np.zeros(len(raw), bool)
                last[-1:] = True
                edges = [0, *(np.flatnonzero(self.boundaries.cuts(raw, last)) + 1).tolist(), len(raw)]
                for a, b in zip(edges, edges[1:]):
                    out.extend(t.id for t in (self.ending if b == len(raw) else self.inner).tokenize(piece[a:b]))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join([self.tokens[i] for i in ids])

    def _agrees(self) -> bool:
        """Whether taking words apart on bytes gives the library's ids, on
        probes; if not, the library cuts every word into pieces."""
        flat, size = self.texts(pa.array(_PROBES))
        want = [self.tokenizer.encode(p, add_special_tokens=False).ids for p in _PROBES]
        self.known = IdTable(self.dtype)
        return size.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


_ENCODERS: dict[tuple[str, bool], FragmentEncoder] = {}


def encoder(path: str, by_word: bool) -> FragmentEncoder:
    """A tokenizer's tables, loaded once per worker."""
    key = (path, by_word)
    if key not in _ENCODERS:
        _ENCODERS.clear()  # one tokenizer's tables at a time
        _ENCODERS[key] = FragmentEncoder(path, by_word)
    return _ENCODERS[key]


def _rows(docs: DataFrame, path: str, by_word: bool, id_col: str, text_col: str, kinds: list[pa.DataType],
          fields: list[T.StructField], make) -> DataFrame:
    """Map documents to ``id_col`` and the columns that ``make`` gives for
    (encoder, one document's ids)."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for batch in batches:
            enc = enc or encoder(path, by_word)
            for part in slices(batch, limit=SLICE_BYTES):
                flat, size = enc.texts(part.column(1))
                end = np.cumsum(size).tolist()
                made = [make(enc, flat[a:b]) for a, b in zip([0, *end], end)]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=schema.names)
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, tokenizer_path: str, by_word: bool = False, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col``, ids (array of int) of each whole text."""
    return _rows(docs, tokenizer_path, by_word, id_col, text_col, [pa.list_(pa.int32())],
                 [T.StructField("ids", T.ArrayType(T.IntegerType()))], lambda enc, ids: (ids.astype(np.int32),))


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, text: the text of each array of ids (null: empty)."""
    src = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for batch in batches:
            enc = enc or encoder(tokenizer_path, False)
            texts = [enc.decode(row.as_py() or []) for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, tokenizer_path: str, by_word: bool = False, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, ids_sha256 (of the decimal ids joined by one
    space), decoded_sha256 (of the text that the ids decode to)."""

    def digests(enc: FragmentEncoder, ids: np.ndarray) -> tuple[int, str, str]:
        listed = ids.tolist()
        shown = " ".join([enc.numbers[i] for i in listed])
        return (len(listed), hashlib.sha256(shown.encode()).hexdigest(),
                hashlib.sha256(enc.decode(listed).encode()).hexdigest())

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return _rows(docs, tokenizer_path, by_word, id_col, text_col, [pa.int64(), pa.string(), pa.string()], fields, digests)
