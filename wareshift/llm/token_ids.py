"""Token ids as binary blocks: frequency-ranked, byte-aligned
variable-length codes with separate control bytes.

Format (a folder written by Spark, so a lost task is simply redone):

* ``ranks``: one row, ``ids`` = the token ids by falling corpus frequency
  (at most the vocabulary, ties by smaller id);
* ``blocks``: rows ordered by (``part``, ``block``); each holds whole
  documents in ascending id order: ``doc_ids``, ``lengths``, ``before`` (ids
  of the earlier blocks of the part), ``n_ids``, ``control`` and ``data``.

An id is stored as its rank in one to four little-endian bytes of ``data``;
``control`` holds two bits per id (bytes minus one), four ids a byte, first
id lowest.  Decoding looks the lengths of four ids up by control byte.

Defined results: null text is an empty text (its one id is the end id); a
null document id sorts first; repeated document ids are kept, ordered by
their ids' checksum; an empty table gives a folder without blocks.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.llm.idtable import IdTable, ragged
from wareshift.llm.stage import written
from wareshift.llm.text import Words, segment_hashes, slices

#: Ids after which a block ends (its last document is completed).
BLOCK_IDS = 262_144
#: Bytes of text whose distinct words are encoded together.
SLICE_BYTES = 4_000_000

_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of an array of ranks."""
    r = ranks.astype(np.uint32)
    length = (1 + (r > 0xFF) + (r > 0xFFFF) + (r > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    padded[: len(r)] = length - 1
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    as_bytes = r.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), as_bytes[np.arange(4) < length[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of ``pack``."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    end = np.cumsum(length)
    start = end - length
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = np.zeros(n, np.uint32)
    for k in range(4):
        out |= np.where(length > k, raw[start + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


# Classes of the bytes of a lower-case text.
_LETTER, _DIGIT, _SIGN, _ODD = 1, 2, 3, 4
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[ord("'")] = _ODD  # may start a contraction
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("A") : ord("Z") + 1] = _CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_LATIN = 0xC3  # first byte of the letters À to ÿ, and of the signs × and ÷


class Units:
    """The units of the words of a column, as segments of ``data``.

    A word of ASCII (without an apostrophe or a special token's string) and
    the letters À to ÿ falls into runs of letters, single digits and runs of
    signs, in lower case; any other word is one unit as it stands
    (``odd``)."""

    def __init__(self, words: Words, specials: list[str]):
        data, start = words.data, words.start
        before = np.zeros(len(data), np.uint8)
        before[1:] = data[:-1]
        kind = _CLASS[data]
        latin = data == _LATIN
        second = (before == _LATIN) & (data >= 0x80)
        kind[latin | (second & (data != 0x97) & (data != 0xB7))] = _LETTER
        odd = kind == _ODD
        for s in specials:
            raw = s.encode()
            if len(raw) > 1:
                odd[1:] |= (data[1:] == raw[1]) & (before[1:] == raw[0])
            else:
                odd |= data == raw[0]
        odd_word = np.logical_or.reduceat(odd, start)
        odd_byte = np.zeros(len(data), bool)
        odd_byte[start[0] :] = np.repeat(odd_word, np.diff(np.append(start, len(data))))
        raised = ((data >= 65) & (data <= 90)) | (second & (data <= 0x9E))
        self.data = np.where(raised & ~odd_byte, data + np.uint8(32), data)
        first = np.zeros(len(data), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        first &= (kind > 0) & ~odd_byte
        first[start] = True
        self.start = np.flatnonzero(first)
        word = np.searchsorted(start, self.start, side="right") - 1
        self.end = np.minimum(np.append(self.start[1:], len(data)), words.end[word])
        self.odd = odd_word[word]
        #: index of the first unit of each row, and one past the last
        self.first = np.searchsorted(self.start, words.offsets)


_PROBES = ("Hello a1b22,,c Éàß--x ÀÖØÞ tion.***", "(~) x_y 2024-01-01 straße; it's 'tis x×y", " a\n\tB ", "", "日本 é́")


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(shown))}


class Encoder:
    """Ids of whole texts from a ``tokenizers`` file.

    ``by_word``: the tokenizer drops white space and never joins across it,
    so a text's ids are its words' ids in a row.  Words fall into units (see
    Units); each distinct unit of a slice is looked up once, in a table of
    fixed size.  The library's model tokenizes the units not found, the
    whole tokenizer the odd words; if the two disagree on probes, every word
    goes through the whole tokenizer.
    """

    def __init__(self, path: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_word = by_word
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known = IdTable(self.dtype)
        self.plain = by_word and self._agrees()

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and each row's number of ids."""
        if not self.by_word:
            found = self.tokenizer.encode_batch([t or "" for t in column.to_pylist()], add_special_tokens=False)
            sizes = np.array([len(e.ids) for e in found], np.int64)
            return np.concatenate([np.array(e.ids, self.dtype) for e in found]), sizes
        words = Words(column)
        if not len(words):
            return np.zeros(0, self.dtype), np.zeros(len(column), np.int64)
        units = Units(words, self.specials) if self.plain else _whole_words(words)
        key = segment_hashes(units.data, units.start, units.end, 1)
        other = segment_hashes(units.data, units.start, units.end, 2)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        clash = np.flatnonzero(other != other[first[which]])
        if len(clash):  # equal first fingerprints of different units
            which[clash] = len(first) + np.arange(len(clash))
            first = np.concatenate([first, clash])
        raw = units.data.tobytes()

        def compute(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = first[new]
            found = [(self._whole if odd else self._unit)(raw[a:b])
                     for a, b, odd in zip(units.start[at].tolist(), units.end[at].tolist(), units.odd[at].tolist())]
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
            return np.frombuffer(b"".join(found), self.dtype), sizes

        flat, begin, size = self.known.ids(key[first], other[first], compute)
        size = size[which]
        per_row = np.concatenate([[0], np.cumsum(size)])[units.first]
        return flat[ragged(begin[which], size)], np.diff(per_row)

    def _whole(self, word: bytes) -> bytes:
        return array(self.code, self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def _unit(self, unit: bytes) -> bytes:
        spelled = unit.decode() if unit.isascii() else unit.decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _agrees(self) -> bool:
        """Whether units give what the whole tokenizer gives, on probes."""
        self.plain = True
        flat, size = self.texts(pa.array(_PROBES))
        want = [self.tokenizer.encode(p, add_special_tokens=False).ids for p in _PROBES]
        return size.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def _whole_words(words: Words):
    units = Units.__new__(Units)
    units.data, units.start, units.end, units.first = words.data, words.start, words.end, words.first
    units.odd = np.ones(len(words), bool)
    return units


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, by_word: bool) -> Encoder:
    """A tokenizer, loaded once per worker."""
    key = (path, by_word)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, by_word)
    return _ENCODERS[key]


def encode(docs: DataFrame, tokenizer_path: str, end_id: int, by_word: bool, id_col: str, text_col: str) -> DataFrame:
    """id, row (its number in this run), ids (little-endian, the end id last),
    crc (of the ids as 32-bit integers)."""
    src = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                      F.col(text_col).cast("string").alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, row bigint, ids binary, crc bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for batch in batches:
            enc = enc or encoder(tokenizer_path, by_word)
            for part in slices(batch, limit=SLICE_BYTES):
                flat, size = enc.texts(part.column(2))
                end = np.cumsum(size)
                flat = np.insert(flat, end, end_id)  # after each row's own ids
                end = end + np.arange(1, len(end) + 1)
                begin = end - size - 1
                rows = [flat[a:b] for a, b in zip(begin.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                    pa.array([zlib.crc32(r.astype("<u4").tobytes()) for r in rows], pa.int64()),
                ], names=["id", "row", "ids", "crc"])
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, schema)


def token_ranks(encoded: DataFrame, dtype: np.dtype, size: int) -> np.ndarray:
    """Token ids by falling frequency.  Each task counts its ids in one array
    of the vocabulary's size; the driver gets one row per id that occurs, the
    vocabulary at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                np.add(total, np.bincount(np.frombuffer(ids.as_buffer(), dtype), minlength=size), out=total) \
                    if len(ids.as_buffer()) > 4 * size else np.add.at(total, np.frombuffer(ids.as_buffer(), dtype), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    counted = encoded.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    rows = np.array([(r.id, r.n) for r in counted.collect()], np.int64).reshape(-1, 2)
    return rows[np.lexsort((rows[:, 0], -rows[:, 1])), 0]


def write_token_ids(docs: DataFrame, out: str, tokenizer_path: str, end_id: int, by_word: bool = False,
                    id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents and write the folder ``out``.

    The encoded rows are written once (the frequencies and the sort's
    sampling read them again), dealt by ranges of document id and packed in
    that order.  Rows of one id are dealt on by checksum and row number, so a
    hot id does not fill one task.
    """
    spark = docs.sparkSession
    enc = encoder(tokenizer_path, by_word)
    dtype, size = enc.dtype, max(enc.size, end_id + 1)
    encoded = written(encode(docs, tokenizer_path, end_id, by_word, id_col, text_col), "token-ids")
    order = token_ranks(encoded, dtype, size)
    spark.createDataFrame([(order.tolist(),)], "ids array<int>").coalesce(1).write.parquet(f"{out}/ranks")
    rank = np.zeros(size, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    id_type = encoded.schema["id"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()),
        T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        block = before = held = 0
        names: list = []
        arrays: list[np.ndarray] = []
        id_kind = None

        def close() -> pa.RecordBatch:
            ids = np.concatenate(arrays)
            control, data = pack(rank[ids])
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([before], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([names], pa.list_(id_kind)),
                pa.array([[len(a) for a in arrays]], pa.list_(pa.int64())),
                pa.array([control], pa.binary()), pa.array([data], pa.binary())], names=schema.names)

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                names.append(doc)
                arrays.append(np.frombuffer(ids.as_buffer(), dtype))
                held += len(arrays[-1])
                if held >= BLOCK_IDS:
                    yield close()
                    block, before, held = block + 1, before + held, 0
                    names, arrays = [], []
        if arrays:
            yield close()

    dealt = encoded.repartitionByRange("id", "crc", "row").sortWithinPartitions("id", "crc", "row").select("id", "ids")
    dealt.mapInArrow(blocks, schema).write.parquet(f"{out}/blocks")


def read_token_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of
    each document, decoded from the blocks; ``with_ids`` adds ``ids``, the
    little-endian 32-bit integers themselves."""
    ids_by_rank = np.array(spark.read.parquet(f"{path}/ranks").first()[0], "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row per part, as many as the write had partitions
    totals = sorted((r.part, r.n) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    start_of: dict[int, int] = {}
    so_far = 0
    for part, n in totals:
        start_of[part] = so_far
        so_far += n
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1)
                part, before, n = (b.column(k)[0].as_py() for k in range(3))
                size = b.column(4)[0].values.to_numpy(zero_copy_only=False)
                ids = ids_by_rank[unpack(b.column(5)[0].as_py(), b.column(6)[0].as_py(), n)]
                end = np.cumsum(size)
                rows = [ids[a:z].tobytes() for a, z in zip((end - size).tolist(), end.tolist())]
                out = [b.column(3)[0].values, pa.array(start_of[part] + before + end - size), pa.array(size),
                       pa.array([zlib.crc32(r) for r in rows], pa.int64())]
                yield pa.RecordBatch.from_arrays(out + [pa.array(rows, pa.binary())] * with_ids, names=names)

    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return blocks.select("part", "before", "n_ids", "doc_ids", "lengths", "control", "data").mapInArrow(run, schema)
