"""A filter of fixed size: which 64-bit fingerprints a table may hold.

One bit for the first 26 bits of a fingerprint at most, in 256 rows of up to
32 KB that are broadcast: whatever is in the table passes, of all else the
share of the bits that are set, a sixteenth or less up to 4 million values.
So a large table can be narrowed before a shuffle, at no more than 8 MB, and
an exact join after it decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareshift.llm.stage import written

#: Bits of a fingerprint that name its row, and those that name its bit there
#: at most; bits of a row for each value in it.
_PART, _PLACE, _ROOM = 8, 18, 16
#: Fingerprints gathered in a task before they are handed on.
GATHER = 3_000_000


def bit_filter(values: DataFrame, least: int = 1) -> DataFrame:
    """(part, bits, places) of the fingerprints in the only column (bigint, or arrays
    of it) that are there ``least`` times, once or twice, at least.

    A fingerprint crosses the shuffle as four bytes, at most ``least`` times
    for each 3 million; its first 40 bits are compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            short, count = np.unique(np.concatenate(held) >> np.uint64(64 - _PART - 32), return_counts=True)
            short = np.repeat(short, np.minimum(count, least))
            cut = np.searchsorted(short, np.arange((1 << _PART) + 1, dtype=np.uint64) << np.uint64(32))
            short = short.astype(np.uint32)
            part = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays([
                pa.array(part, pa.int64()),
                pa.array([short[a:b].tobytes() for a, b in zip(cut[part].tolist(), cut[part + 1].tolist())], pa.binary())],
                names=["part", "values"])

        for batch in batches:
            column = batch.column(0)
            column = column.flatten() if pa.types.is_list(column.type) else column
            held.append(column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            size += len(held[-1])
            if size > GATHER:
                yield close()
                held, size = [], 0
        if held:
            yield close()

    def bits(found: pa.Table) -> pa.Table:
        value, count = np.unique(np.frombuffer(b"".join(found.column("values").to_pylist()), np.uint32), return_counts=True)
        value = value[count >= least]
        place = min(max(6, (_ROOM * len(value)).bit_length()), _PLACE)
        on = np.zeros(1 << place, bool)
        on[value >> np.uint32(32 - place)] = True
        words = np.packbits(on, bitorder="little").view(np.int64)
        return pa.table({"part": found.column("part").slice(0, 1), "bits": pa.array([words], pa.list_(pa.int64())),
                         "places": pa.array([place], pa.int32())})

    parts = values.mapInArrow(run, "part bigint, values binary").groupBy("part")
    return written(parts.applyInArrow(bits, "part bigint, bits array<bigint>, places int"), "bits", rows=1 << _PART)


def passed(df: DataFrame, value: Column, bits: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose value the filter may hold; the others with left_anti."""
    part = bits.select(F.col("part").alias("__part"), F.col("bits").alias("__bits"), F.col("places").alias("__places"))
    # the bits after the part's, as many as the row has places for
    place = F.call_function("shiftrightunsigned", F.shiftleft(value, _PART), F.lit(64) - F.col("__places"))
    word, bit = F.shiftright(place, 6).cast("int"), place.bitwiseAND(63).cast("int")
    return df.join(F.broadcast(part), (F.shiftrightunsigned(value, 64 - _PART) == F.col("__part"))
                   & (F.getbit(F.get("__bits", word), bit) == 1), how)
