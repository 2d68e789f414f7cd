"""Carry out a mismatch report -- re-export the listed tables and load
them into the target anew.

Each listed table is a job of its own: its columns come from the schema
rows, its rows from the source; the export and the target's copy are both
written beside what is there and take its place when complete.  A table
that fails, or whose lines do not all load, keeps its old copy and is
reported; the others go on.  A journal holds a row per finished table and
run, so a rerun of the same run continues where the last one stopped, and a
run repeated under another name gives the same tables again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareshift.operators.reconcile import reload_plan
from wareshift.sources.delimited import PART_BYTES, export_table, import_delimited
from wareshift.sources.generations import current, read_current, replace

JOURNAL = "run string, table_name string, state string, written bigint, quarantined bigint, loaded bigint, parts int"
#: Tables whose jobs run side by side.
TABLES_AT_ONCE = 4


class Reloaded(NamedTuple):
    """One listed table's outcome: ``loaded``, ``no schema``, ``rejected``
    (lines that do not load) or ``failed``."""

    run: str
    table_name: str
    state: str
    written: int
    quarantined: int
    loaded: int
    parts: int


def _journal(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(JOURNAL).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], JOURNAL)
        raise


def target_path(target_root: str, db: str, tbl: str) -> str:
    return f"{target_root.rstrip('/')}/{db}.{tbl}"


def read_target(spark: SparkSession, target_root: str, db: str, tbl: str) -> DataFrame | None:
    """The target's copy of a table, or None if it has none."""
    return read_current(spark, target_path(target_root, db, tbl))


def reload_tables(report: DataFrame, schema_cols: DataFrame, read_source: Callable[[str, str], DataFrame],
                  export_root: str, target_root: str, quarantine_root: str, journal: str, run: str,
                  max_bytes: int = PART_BYTES, at_once: int = TABLES_AT_ONCE) -> DataFrame:
    """Re-export and load every table of ``report`` (``table_name`` =
    ``db.tbl``); other tables are not touched.  ``schema_cols`` (db, tbl,
    pos, name) names the columns in order, ``read_source(db, tbl)`` gives the
    rows.  Returns the run's rows of ``journal``.

    The report and the schema rows of the listed tables come to the driver:
    a row per table and column of the catalog, never rows of a table."""
    spark = report.sparkSession
    columns: dict[str, list[tuple[int, str]]] = {}
    for r in reload_plan(report, schema_cols).select("db", "tbl", "pos", "name").collect():
        columns.setdefault(f"{r.db}.{r.tbl}", []).append((r.pos, r.name))
    done = {r.table_name for r in _journal(spark, journal).where((F.col("run") == run) & (F.col("state") == "loaded"))
            .select("table_name").collect()}
    names = sorted({r.table_name for r in report.select("table_name").collect()} - done)

    def one(name: str) -> Reloaded:
        if name not in columns:
            return Reloaded(run, name, "no schema", 0, 0, 0, 0)
        db, tbl = name.split(".", 1)
        try:
            return _reload(spark, read_source(db, tbl), [c for _, c in sorted(columns[name])], db, tbl, export_root,
                           target_root, quarantine_root, run, max_bytes)
        except Exception as e:  # the others go on; the old copy stays
            return Reloaded(run, name, f"failed: {type(e).__name__}", 0, 0, 0, 0)

    with ThreadPoolExecutor(at_once) as pool:
        for out in pool.map(one, names):
            spark.createDataFrame([tuple(out)], JOURNAL).coalesce(1).write.mode("append").parquet(journal)
    latest = _journal(spark, journal).where(F.col("run") == run).groupBy("table_name").agg(
        F.max(F.struct((F.col("state") == "loaded").alias("ok"), "state", "written", "quarantined", "loaded", "parts")).alias("m"))
    return latest.select(F.lit(run).alias("run"), "table_name", *[
        F.col(f"m.{c}").alias(c) for c in ("state", "written", "quarantined", "loaded", "parts")])


def _reload(spark: SparkSession, source: DataFrame, columns: Sequence[str], db: str, tbl: str, export_root: str,
            target_root: str, quarantine_root: str, run: str, max_bytes: int) -> Reloaded:
    rows = source.select(*[F.col(f"`{c}`") for c in columns])
    out = export_table(rows, export_root, db, tbl, quarantine_root, max_bytes)
    good, rejected = import_delimited(spark, f"{export_root.rstrip('/')}/{db}.{tbl}", rows.schema)
    bad = rejected.count()
    if bad:
        return Reloaded(run, f"{db}.{tbl}", "rejected", out.written, out.quarantined, 0, out.parts)
    replace(spark, target_path(target_root, db, tbl), lambda folder: good.write.mode("overwrite").parquet(folder))
    loaded = spark.read.parquet(current(spark, target_path(target_root, db, tbl))).count()
    return Reloaded(run, f"{db}.{tbl}", "loaded", out.written, out.quarantined, loaded, out.parts)
