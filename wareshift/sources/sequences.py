"""Sequences that continue across runs.

A sequence is a table of reservations: each batch of rows reserves one block
of ids, once.  The next block begins after the highest one reserved, so ids
of an unfinished batch are never given to another; a batch that is retried
or replayed finds its block and gives its rows the same ids again.  One
writer per sequence at a time (the job that loads its table); two that
reserve the same block are told.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareshift.operators.changes import with_sequence

BLOCKS = "sequence string, batch string, first bigint, n bigint"


def reservations(spark: SparkSession, path: str) -> DataFrame:
    """All reserved blocks: sequence, batch, first, n."""
    try:
        return spark.read.schema(BLOCKS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], BLOCKS)
        raise


def reserve(spark: SparkSession, path: str, sequence: str, batch: str, n: int, start: int = 1) -> int:
    """First id of the block of ``n`` ids that ``batch`` holds."""
    held = reservations(spark, path).filter(F.col("sequence") == sequence)
    mine = F.when(F.col("batch") == batch, F.struct("first", "n"))
    top = held.agg(F.max(F.col("first") + F.col("n")).alias("end"), F.max(mine).alias("mine")).first()
    if top["mine"] is not None:
        if n > top["mine"]["n"]:
            raise ValueError(f"batch {batch} of {sequence} reserved {top['mine']['n']} ids and now needs {n}: "
                             "it is not the same batch")
        return top["mine"]["first"]
    first = start if top["end"] is None else top["end"]
    if n:
        spark.createDataFrame([(sequence, batch, first, n)], BLOCKS).coalesce(1).write.mode("append").parquet(path)
        at_once = reservations(spark, path).filter((F.col("sequence") == sequence) & (F.col("first") == first)).count()
        if at_once != 1:
            raise RuntimeError(f"block {first} of {sequence} was reserved twice at once; one writer per sequence")
    return first


def with_stored_sequence(df: DataFrame, path: str, sequence: str, batch: str, name: str = "seq_id",
                         order_by: Sequence[str | Column] | None = None, start: int = 1) -> DataFrame:
    """Dense ids in ``order_by`` order that follow those of earlier batches.

    The rows are numbered as in :func:`with_sequence` (ties by row hash), so
    a replay of the same rows under the same batch gives each its id again."""
    numbered = with_sequence(df, "__n", 0, order_by)
    first = reserve(df.sparkSession, path, sequence, batch, numbered.count(), start)
    return numbered.withColumn(name, F.lit(first).cast("bigint") + F.col("__n")).drop("__n")
