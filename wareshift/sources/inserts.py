"""Rows -> ``insert into t (cols) values (...),(...)`` statements.

Rows are numbered densely in key order (no global window, see
``with_sequence``) and grouped ``batch`` rows per statement; a group holds at
most ``batch`` rows, so the per-statement collect is bounded.  Strings are
quoted with backslash and quote escaped (the original did not escape),
numbers are raw, timestamps are cut to whole seconds, null is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareshift.operators.changes import row_hash, with_sequence


def sql_literal(c: str, dtype: str) -> Column:
    col = F.col(c)
    if dtype == "string":
        esc = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        v = F.concat(F.lit("'"), esc, F.lit("'"))
    elif dtype.startswith("timestamp"):
        v = F.concat(F.lit("'"), F.date_format(col, "yyyy-MM-dd HH:mm:ss"), F.lit("'"))
    elif dtype == "date":
        v = F.concat(F.lit("'"), F.date_format(col, "yyyy-MM-dd"), F.lit("'"))
    elif dtype == "boolean":
        v = col.cast("int").cast("string")
    elif dtype in ("bigint", "int", "smallint", "tinyint", "double", "float") or dtype.startswith("decimal"):
        v = col.cast("string")
    else:
        raise TypeError(f"no literal form for type {dtype} of column {c}")
    return F.coalesce(v, F.lit("NULL"))


def to_insert_values(df: DataFrame, table: str, order_by: Sequence[str] | None, batch: int = 1000,
                     max_bytes: int = 3_000_000) -> DataFrame:
    """Insert statements (batch, part, stmt) of at most ``batch`` rows and
    about ``max_bytes`` bytes of row text.

    A batch is cut into parts by its running bytes: a row of more than half
    of ``max_bytes`` has a part to itself (a single row can exceed the
    bound, no row is dropped), the others of a part stay below the bound.

    With ``order_by`` the rows are numbered densely in that order (one range
    sort and a checkpoint of the numbered rows) and batch ``b`` holds rows
    ``b*batch .. b*batch+batch-1``.  Without it, batches are cut inside each
    input partition (partition id, position // batch): no shuffle, no
    checkpoint, same batch cap -- the cheap form when statement order does
    not matter.  The rows of a partition are first sorted by their hash, so
    the positions depend only on which rows the partition holds, not on the
    order they arrive in: a partition recomputed after a lost executor (a
    shuffle output arrives in any order) cuts the same batches."""
    types = dict(df.dtypes)
    cols = list(df.columns)
    row = F.concat(F.lit("("), F.concat_ws(", ", *[sql_literal(c, types[c]) for c in cols]), F.lit(")"))
    if order_by:
        # the checkpoint holds the sort key and the row's text, no other column
        numbered = with_sequence(df.select(*order_by, row.alias("__row")), "__seq", 0, order_by=list(order_by))
        key = F.floor(F.col("__seq") / batch).cast("bigint")
    else:
        pid = F.spark_partition_id().cast("long")
        pos = F.monotonically_increasing_id() - pid * (1 << 33)
        numbered = df.sortWithinPartitions(row_hash(df)).select(row.alias("__row"), pid.alias("__pid"),
                                                                 pos.alias("__seq"))
        key = (F.col("__pid") * (1 << 33) + F.floor(F.col("__seq") / batch)).cast("bigint")
    # bytes before a row, in halves of the bound: a larger row ends its half
    half, size = max(1, max_bytes // 2), F.octet_length("__row")
    order = Window.partitionBy("batch").orderBy("__seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = numbered.select(key.alias("batch"), "__seq", "__row").withColumn(
        "__before", F.sum(size.cast("bigint")).over(order) - size)
    part = F.floor(F.col("__before") / half) * 2 + (size > half).cast("bigint")
    g = sized.groupBy("batch", part.cast("bigint").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("__seq", "__row"))).alias("__rows"))
    head = f"insert into {table} ({', '.join(cols)}) values "
    return g.select("batch", "part", F.concat(F.lit(head), F.array_join(F.transform("__rows", lambda x: x["__row"]), ",")).alias("stmt"))
