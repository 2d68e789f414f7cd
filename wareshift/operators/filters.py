"""Projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareshift.operators.joins import lookup_join

# Business databases are those with these prefixes/suffixes or
# in the special list; temporary (leading ___) and *_text copies are not.
BUSINESS_PREFIXES = ("global_", "asset_")
BUSINESS_SUFFIX = "_custom"
SPECIAL_DBS = ("public_data", "dp_stat")
DROP_PREFIX = "___"
DROP_SUFFIX = "_text"
# In the statistics db, history tables and query-log tables
# are not migrated.
STAT_DB = "dp_stat"
STAT_DROP_SUFFIX = "_history"
STAT_DROP_PREFIX = "impala_query_log"


def is_business_db(db) -> Column:
    d = F.col(db) if isinstance(db, str) else db
    keep = d.startswith(BUSINESS_PREFIXES[0])
    for p in BUSINESS_PREFIXES[1:]:
        keep = keep | d.startswith(p)
    keep = keep | d.endswith(BUSINESS_SUFFIX) | d.isin(list(SPECIAL_DBS))
    return keep & ~d.startswith(DROP_PREFIX) & ~d.endswith(DROP_SUFFIX)


def business_dbs(df: DataFrame, db: str = "db", ignore: Sequence[str] = ()) -> DataFrame:
    """P1."""
    cond = is_business_db(db)
    if ignore:
        cond = cond & ~F.col(db).isin(list(ignore))
    return df.filter(cond)


def keep_table(db, tbl) -> Column:
    d = F.col(db) if isinstance(db, str) else db
    t = F.col(tbl) if isinstance(tbl, str) else tbl
    return ~((d == STAT_DB) & (t.endswith(STAT_DROP_SUFFIX) | t.startswith(STAT_DROP_PREFIX)))


def skip_tables(df: DataFrame, db: str = "db", tbl: str = "tbl") -> DataFrame:
    """P2."""
    return df.filter(keep_table(db, tbl))


def bool_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column -> int 0/1, other columns unchanged."""
    return df.select(*[
        F.col(c).cast("int").alias(c) if t == "boolean" else F.col(c) for c, t in df.dtypes
    ])


def key_first(df: DataFrame, key: str) -> DataFrame:
    """P5: move a key column to position 1."""
    if key not in df.columns:
        return df
    return df.select(key, *[c for c in df.columns if c != key])


def not_removed(df: DataFrame, flag: str = "is_removed") -> DataFrame:
    """P6 soft-delete filter."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def drop_blocked(df: DataFrame, blocked: DataFrame, col: str, blocked_col: str | None = None) -> DataFrame:
    """P11 block-list as a left-anti join (the list is broadcast by the
    planner when it is under the size threshold; a hot id of the log stays
    splittable otherwise)."""
    b = blocked.select(F.col(blocked_col or col).alias("__blocked")).distinct()
    return lookup_join(df, b, [col], ["__blocked"], "left_anti")


def mark_blocked(df: DataFrame, blocked: DataFrame, col: str, flag: str = "enabled") -> DataFrame:
    """P11 as in the reference: set ``enabled = false`` for listed ids."""
    b = blocked.select(F.col(col).alias("__blocked")).distinct().withColumn("__blk", F.lit(True))
    prior = F.coalesce(F.col(flag), F.lit(True)) if flag in df.columns else F.lit(True)
    joined = lookup_join(df, b, [col], ["__blocked"], "left")
    return joined.withColumn(flag, prior & F.col("__blk").isNull()).drop("__blk", "__blocked")


def base_tables(catalog: DataFrame, db: str | None = None, table_type: str = "table_type") -> DataFrame:
    """Keep base tables (not views) of one schema or of all schemas."""
    cond = F.col(table_type) == "BASE TABLE"
    if db is not None:
        cond = cond & (F.col("db") == db)
    return catalog.filter(cond)


def tables_in_schema_files(catalog: DataFrame, schema_cols: DataFrame, keys: Sequence[str] = ("db", "tbl")) -> DataFrame:
    """Keep the catalog rows of tables listed in the schema files."""
    return catalog.join(schema_cols.select(*keys).distinct(), list(keys), "left_semi")
