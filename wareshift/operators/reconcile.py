"""Reconciliation of two copies of a warehouse.

Catalog frames are small (one row per db/table/column); the data checks
run one aggregate per side and per table, so only per-table summaries are
joined -- never the rows of the two copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareshift.functions.scalars import round_to_second
from wareshift.operators.aggregates import field_maxima
from wareshift.operators.setops import presence


def _sorted_list(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_list(F.col(c))), ",")


def diff_databases(a: DataFrame, b: DataFrame, db: str = "db") -> DataFrame:
    """Every db name with side both / source_only / target_only."""
    return presence(a.select(db), b.select(db), [db])


def common_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), list(keys), "inner")


def diff_tables(a: DataFrame, b: DataFrame, db: str = "db", tbl: str = "tbl") -> DataFrame:
    """R2: per common db, tables on one side only and the common count."""
    dbs = common_keys(a, b, [db])
    p = presence(a.join(dbs, db, "left_semi"), b.join(dbs, db, "left_semi"), [db, tbl])
    side = F.col("side")
    return p.groupBy(db).agg(
        F.sum(F.when(side == "source_only", 1).otherwise(0)).cast("bigint").alias("source_only"),
        F.sum(F.when(side == "target_only", 1).otherwise(0)).cast("bigint").alias("target_only"),
        F.sum(F.when(side == "both", 1).otherwise(0)).cast("bigint").alias("common"),
        F.coalesce(F.array_join(F.array_sort(F.collect_list(F.when(side == "source_only", F.col(tbl)))), ","),
                   F.lit("")).alias("missing_in_target"),
    )


def diff_columns(a: DataFrame, b: DataFrame, db: str = "db", tbl: str = "tbl", col: str = "col") -> DataFrame:
    """Per common table, column counts, columns on one side only (both
    directions, unlike the original which compared a set with itself) and
    ``schema_match``."""
    tables = common_keys(a, b, [db, tbl])
    p = presence(a.join(tables, [db, tbl], "left_semi"), b.join(tables, [db, tbl], "left_semi"), [db, tbl, col])
    side = F.col("side")
    g = p.groupBy(db, tbl).agg(
        F.sum(F.when(side != "target_only", 1).otherwise(0)).cast("bigint").alias("source_cols"),
        F.sum(F.when(side != "source_only", 1).otherwise(0)).cast("bigint").alias("target_cols"),
        F.array_join(F.array_sort(F.collect_list(F.when(side == "source_only", F.col(col)))), ",").alias("source_only"),
        F.array_join(F.array_sort(F.collect_list(F.when(side == "target_only", F.col(col)))), ",").alias("target_only"),
    )
    return g.withColumn("schema_match", (F.col("source_only") == "") & (F.col("target_only") == ""))


def side_summary(df: DataFrame, table: str | Sequence[str], fields: Sequence[str], timestamp_fields: Sequence[str] = (),
                 round_seconds: bool = False) -> DataFrame:
    """R4/R5 one side: row count and max of each present field per table.
    ``round_seconds`` rounds timestamp fields to whole seconds first (the
    source side, compared against a target that stores whole seconds)."""
    if round_seconds:
        df = df.withColumns({f: round_to_second(f) for f in timestamp_fields if f in df.columns and f in fields})
    return field_maxima(df, fields, _names(table)).withColumnRenamed("row_count", "cnt")


def _names(table: str | Sequence[str]) -> list[str]:
    return [table] if isinstance(table, str) else list(table)


def compare_counts_max(source: DataFrame, target: DataFrame, table: str | Sequence[str] = "tbl",
                       fields: Sequence[str] = ("id", "version", "updated_at"),
                       timestamp_fields: Sequence[str] = ("updated_at",)) -> DataFrame:
    """R4 + R5: counts per table, and when they agree the maxima of
    id/version/updated_at (null-safe ``<=>``: null vs null is equal).
    ``table`` names the key columns; with database and table
    (``["db", "tbl"]``) the result feeds :func:`mismatch_report`."""
    keys = _names(table)
    a = side_summary(source, table, fields, timestamp_fields, round_seconds=True)
    b = side_summary(target, table, fields, timestamp_fields)
    present = [f for f in fields if f in source.columns and f in target.columns]
    a = a.select(*keys, *[F.col(c).alias(f"source_{c}") for c in a.columns if c not in keys])
    b = b.select(*keys, *[F.col(c).alias(f"target_{c}") for c in b.columns if c not in keys])
    j = a.join(b, keys, "full")
    count_match = F.coalesce(F.col("source_cnt") == F.col("target_cnt"), F.lit(False))
    max_match = F.lit(True)
    for f in present:
        max_match = max_match & F.col(f"source_max_{f}").eqNullSafe(F.col(f"target_max_{f}"))
    return j.withColumn("count_match", count_match).withColumn("data_match", count_match & max_match)


def mismatch_report(src_tables: DataFrame, dst_tables: DataFrame, columns_report: DataFrame | None = None,
                    data_report: DataFrame | None = None, db: str = "db", tbl: str = "tbl") -> DataFrame:
    """Tables of dbs missing on the target, tables missing on the target,
    tables failing the schema or data checks; distinct names, sorted."""
    dbs_missing = src_tables.select(db).distinct().join(dst_tables.select(db).distinct(), db, "left_anti")
    parts = [src_tables.join(dbs_missing, db, "left_semi").select(db, tbl)]
    parts.append(src_tables.select(db, tbl).join(dst_tables.select(db, tbl), [db, tbl], "left_anti"))
    if columns_report is not None:
        parts.append(columns_report.filter(~F.col("schema_match")).select(db, tbl))
    if data_report is not None:
        parts.append(data_report.filter(~F.col("data_match")).select(db, tbl))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.select(F.concat_ws(".", db, tbl).alias("table_name")).distinct().orderBy("table_name")


def reload_plan(report: DataFrame, schema_cols: DataFrame, db: str = "db", tbl: str = "tbl",
                name_col: str = "table_name") -> DataFrame:
    """Schema rows of the tables listed in a mismatch report."""
    names = report.select(F.col(name_col).alias("__n"))
    return schema_cols.join(names, F.concat_ws(".", db, tbl) == F.col("__n"), "left_semi")
