"""Delimited text dialect of the bulk loader (S2, S3) and file helpers
(S4, S6, S9, S10, S12).

Dialect (fixed values): field separator ``\\x06``, row terminator
``\\x07``, escape ``\\``, null written as ``\\N``, no quotes, no header,
booleans as 0/1.  Spark's csv writer with ``quote=''`` quotes with NUL
bytes and does not round-trip, so the text source/sink is used with a
custom ``lineSep`` and the fields are escaped/tokenised with built-in
regex functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.operators.filters import bool_to_int
from wareshift.sources.generations import current, current_slots, replace

# The loader's file dialect.
FIELD_SEP = "\u0006"
ROW_SEP = "\u0007"
ESCAPE = "\\"
NULL_TEXT = "\\N"
PART_BYTES = 256 * 1024 * 1024

_ESCAPE_RE = "([\\\\\u0006\u0007])"
# One field after a separator (the line gets a leading separator, so every
# match is at least one character long and an empty first field is not
# skipped).  The body is the unrolled form "plain run, then (escape pair,
# plain run)*" with possessive quantifiers: Java's regex engine runs it as
# a loop instead of recursing per character, so fields of millions of
# characters parse (the alternation form overflows the stack from about a
# thousand characters).
_FIELD_RE = "(?s)\u0006([^\\\\\u0006]*+(?:\\\\.[^\\\\\u0006]*+)*+)"
_UNESCAPE_RE = "(?s)\\\\(.)"


def escape_field(c: Column) -> Column:
    """Escape ``\\``, the field and the row separator; null -> ``\\N``."""
    return F.coalesce(F.regexp_replace(c.cast("string"), _ESCAPE_RE, "\\\\$1"), F.lit(NULL_TEXT))


def to_lines(df: DataFrame) -> DataFrame:
    """One ``value`` string per row in the loader dialect, plus a flag for
    rows holding a row separator (an escaped ``\\x07`` would still split the
    line when read back, so such rows are quarantined)."""
    d = bool_to_int(df)
    has_eol = F.lit(False)
    for c in d.columns:
        has_eol = has_eol | F.coalesce(F.col(c).cast("string").contains(ROW_SEP), F.lit(False))
    line = F.concat_ws(FIELD_SEP, *[escape_field(F.col(c)) for c in d.columns])
    return d.select(line.alias("value"), has_eol.alias("quarantined"))


class Exported(NamedTuple):
    """Rows written and quarantined; of a cut export the number of parts and
    the folder that holds them."""

    written: int
    quarantined: int
    parts: int | None = None
    folder: str | None = None


def _quarantine(df: DataFrame, path: str, mode: str, n: int) -> None:
    """Write the ``n`` rows that hold a row separator, with their original
    columns; the input is read for them only if there are any."""
    eol = F.lit(False)
    for c in df.columns:
        eol = eol | F.coalesce(F.col(f"`{c}`").cast("string").contains(ROW_SEP), F.lit(False))
    (df.filter(eol) if n else df.limit(0)).write.mode(mode).parquet(path)


def export_delimited(df: DataFrame, path: str, quarantine_path: str, mode: str = "overwrite") -> Exported:
    """Write ``df`` as delimited text; rows with ``\\x07`` cannot be
    written and go to ``quarantine_path`` as parquet.  No row is lost: the
    counts of both are returned, taken while the lines are written."""
    seen = Observation()
    held = F.col("quarantined")
    lines = to_lines(df).observe(seen, F.count(F.lit(1)).alias("n"), F.count(F.when(held, 1)).alias("held"))
    lines.filter(~held).select("value").write.mode(mode).option("lineSep", ROW_SEP).text(path)
    _quarantine(df, quarantine_path, mode, seen.get["held"])
    return Exported(seen.get["n"] - seen.get["held"], seen.get["held"])


def parse_lines(lines: DataFrame, schema: T.StructType, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S3 tokenizer: split on unescaped separators, ``\\N`` -> null, then
    unescape and ``try_cast`` to the schema types.  Returns (good, rejected):
    a line with too few or too many fields, a field that is not of its type,
    or a stray escape at the end goes to the second with its reasons."""
    line = F.concat(F.lit(FIELD_SEP), F.col(col))
    fields = F.regexp_extract_all(line, F.lit(_FIELD_RE), F.lit(1))
    whole = F.regexp_extract_all(line, F.lit(_FIELD_RE), F.lit(0))
    split = lines.select(F.col(col).alias("line"), fields.alias("fields"),
                         (F.length(F.array_join(whole, "")) < F.length(line)).alias("stray"))
    n = len(schema.fields)
    values, reasons = [], [F.when(F.size("fields") != n, F.concat(F.size("fields").cast("string"), F.lit(f" fields, not {n}"))),
                           F.when(F.col("stray"), F.lit("stray escape"))]
    for i, f in enumerate(schema.fields):
        raw = F.get(F.col("fields"), F.lit(i))
        text = F.when(raw == NULL_TEXT, F.lit(None)).otherwise(F.regexp_replace(raw, _UNESCAPE_RE, "$1"))
        if isinstance(f.dataType, T.StringType):
            value = text
        elif isinstance(f.dataType, T.BooleanType):
            value = text.try_cast("int") != 0
        else:
            value = text.try_cast(f.dataType)
        values.append(value.alias(f.name))
        reasons.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"{f.name} is not {f.dataType.simpleString()}")))
    parsed = split.select("line", F.struct(*values).alias("row"), F.array_join(F.array_compact(F.array(*reasons)), ", ").alias("reason"))
    good = parsed.filter(F.col("reason") == "").select("row.*")
    return good, parsed.filter(F.col("reason") != "").select(F.col("line").alias(col), "reason")


def import_delimited(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S3: load delimited files, or the parts of a cut export; (typed rows,
    rejected lines with reasons).  An empty line is a line of one empty
    field: a row of a one-column table, a reject of a wider one."""
    lines = spark.read.option("lineSep", ROW_SEP).text(current(spark, path) or path).select("value")
    return parse_lines(lines, schema)


def _cut_points(lines: DataFrame, max_bytes: int) -> tuple[int, int, dict[int, tuple[int, int]], int, int, int]:
    """How the lines fall into parts, from one aggregate with a row per input
    partition: bytes between cuts, the width from which a line is a part of
    its own, each partition's first numbers (of shared parts, of lines
    alone), the parts and the lines in all, and the quarantined lines."""
    width = (F.octet_length("value") + 1).cast("bigint")
    held = F.col("quarantined")
    alone = max_bytes // 2
    shared = ~held & (width <= alone)
    rows = lines.groupBy(F.spark_partition_id().alias("pid")).agg(
        F.sum(F.when(shared, width)).alias("bytes"), F.max(F.when(shared, width)).alias("widest"),
        F.count(F.when(~held & (width > alone), 1)).alias("alone"), F.count(F.when(~held, 1)).alias("n"),
        F.count(F.when(held, 1)).alias("held")).collect()  # one row per partition
    step = max(1, max_bytes - max((r.widest or 0 for r in rows), default=0))
    first, n = {}, 1
    for r in sorted(rows, key=lambda r: r.pid):
        parts = -(-(r.bytes or 0) // step)
        first[r.pid] = (n, n + parts)
        n += parts + r.alone
    return step, alone, first, n - 1, sum(r.n for r in rows), sum(r.held for r in rows)


def write_sized_parts(df: DataFrame, path: str, quarantine_path: str, max_bytes: int = PART_BYTES,
                      prefix: str = "part") -> Exported:
    """Cut the delimited output into parts of at most ``max_bytes`` on
    row borders, numbered ``prefix.NNN``; a line above half the limit is a
    part of its own.

    Lines stay in their input partition.  A partition's running byte count
    tells the part: a cut falls wherever it passes a multiple of the limit
    less the widest shared line, so that no part exceeds the limit and every
    number is used.  One aggregate per input partition gives the totals that
    number the parts through; then one write puts each part into a folder
    ``file=prefix.NNN`` with one file.  The new parts take the old ones'
    place when they are complete (see :mod:`wareshift.sources.generations`):
    a failure before leaves the table as it was.  The input is read for the
    totals and for the write, so it should be a table or a written frame;
    rows that moved between partitions in between stop the write.  Rows
    holding a row separator go to ``quarantine_path``."""
    spark = df.sparkSession
    lines = to_lines(df)
    step, alone, first, parts, n, held = _cut_points(lines, max_bytes)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shared_at, alone_at = first.get(TaskContext.get().partitionId(), (0, 0))
        end = 0
        for batch in batches:
            width = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            wide = width > alone
            ends = end + np.cumsum(np.where(wide, 0, width))
            number = np.where(wide, alone_at + np.cumsum(wide) - 1, shared_at + (ends - 1) // step)
            end, alone_at = int(ends[-1]) if len(ends) else end, alone_at + int(wide.sum())
            names = pa.array([f"{prefix}.{i:03d}" for i in number.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), names], names=["value", "file"])

    seen = Observation()
    cut = lines.filter(~F.col("quarantined")).select("value").mapInArrow(numbered, "value string, file string").observe(
        seen, F.count(F.lit(1)).alias("n"), F.max(F.col("file").endswith(".000")).alias("lost"))

    def write(folder: str) -> None:
        cut.write.mode("overwrite").partitionBy("file").option("lineSep", ROW_SEP).text(folder)
        if seen.get["n"] != n or seen.get["lost"]:
            raise RuntimeError(f"the input changed while it was exported: {n} lines counted, {seen.get['n']} written")

    _quarantine(df, quarantine_path, "overwrite", held)
    return Exported(n, held, parts, replace(spark, path, write))


def file_manifest(spark: SparkSession, path: str, glob: str = "*", by: str = "name") -> DataFrame:
    """Bytes and files per ``db.table``.  ``by='name'`` takes the table
    from the file name prefix (``db.table.NNN.csv``, the original naming);
    ``by='part'`` from the numbered parts below an export root that count
    now (``<db>.<table>/slots/<slot>/file=<db>.<table>.NNN``, what
    :func:`export_table` writes).  The binary-file source lists files; with
    only path/length selected the file contents are not read."""
    parts = F.split("path", "/")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", by == "part")
    if by == "part":
        found = files.load(f"{path.rstrip('/')}/*/slots").select(
            F.element_at(parts, -5).alias("table"), F.element_at(parts, -3).alias("slot"), "length")
        found = found.join(current_slots(spark, path), ["table", "slot"], "left_semi")
    else:
        found = files.load(path).select(F.substring_index(F.element_at(parts, -1), ".", 2).alias("table"), "length")
    return found.groupBy("table").agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))


def export_table(df: DataFrame, root: str, db: str, table: str, quarantine_root: str,
                 max_bytes: int = PART_BYTES) -> Exported:
    """Export one table for the loader (S1 + P3 + S2 + S4): booleans as
    0/1, escaped delimited text cut into parts of at most ``max_bytes``,
    written to ``<root>/<db>.<table>`` with parts ``<db>.<table>.NNN``; rows
    holding a row separator go to ``<quarantine_root>/<db>.<table>``."""
    name = f"{db}.{table}"
    return write_sized_parts(df, f"{root.rstrip('/')}/{name}", f"{quarantine_root.rstrip('/')}/{name}", max_bytes, name)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append a whole table to another store."""
    df.write.mode("append").format(fmt).save(path)


def write_name_list(df: DataFrame, col: str, path: str) -> None:
    """Sorted distinct names as text.  The global sort range-partitions
    the names, so the part files, read in name order, form one sorted list
    without funnelling it through a single task."""
    df.select(F.col(col).cast("string").alias("value")).distinct().orderBy("value") \
        .write.mode("overwrite").text(path)


def empty_like(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """An empty table with the projected schema."""
    df.limit(0).write.mode("overwrite").format(fmt).save(path)
