"""Folders that are replaced whole, without renames or deletes.

A table's folder holds two slots and an index.  A replacement is written
into the slot that readers do not use; only when it is complete a row
(number, slot) is appended to the index, and the highest number names the
slot that counts.  A job lost half-way therefore leaves the previous
content in place, and its rerun overwrites the unfinished slot.  Works on
any store that Spark writes to.  One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = ("a", "b")


def _index(spark: SparkSession, path: str) -> tuple[int, str] | None:
    try:
        rows = spark.read.schema("n bigint, slot string").parquet(f"{path}/index")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    last = rows.agg(F.max(F.struct("n", "slot")).alias("m")).first()["m"]
    return None if last is None else (last["n"], last["slot"])


def current(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the table's content, or None before the first
    replacement."""
    last = _index(spark, path.rstrip("/"))
    return None if last is None else f"{path.rstrip('/')}/slots/{last[1]}"


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Replace the content by what ``write(folder)`` writes (it must
    overwrite the folder); the folder is returned."""
    path = path.rstrip("/")
    last = _index(spark, path)
    n, slot = (1, SLOTS[0]) if last is None else (last[0] + 1, SLOTS[1 - SLOTS.index(last[1])])
    folder = f"{path}/slots/{slot}"
    write(folder)
    spark.createDataFrame([(n, slot)], "n bigint, slot string").coalesce(1).write.mode("append").parquet(f"{path}/index")
    return folder


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The content of a table kept as parquet."""
    folder = current(spark, path)
    return None if folder is None else spark.read.parquet(folder)


def current_slots(spark: SparkSession, root: str) -> DataFrame:
    """(table, slot) that count, of all tables below ``root``."""
    rows = spark.read.schema("n bigint, slot string").parquet(f"{root.rstrip('/')}/*/index")
    table = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
    return rows.select(table.alias("table"), "n", "slot").groupBy("table").agg(
        F.max(F.struct("n", "slot")).alias("m")).select("table", F.col("m.slot").alias("slot"))
