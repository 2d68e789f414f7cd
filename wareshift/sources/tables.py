"""Read the chosen columns of a table.

Selecting columns right after the read lets Catalyst prune the parquet
``ReadSchema`` to exactly those columns; filters written later are pushed
into the scan as ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.orders`` (read once per
    instance; make a new instance to see files written since)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        # Called only on the first access: the DataFrame is then stored on
        # the instance, so one query's plan lists each table's files once.
        if name not in TABLES:
            raise AttributeError(name)
        df = read_table(self.spark, self.sf_dir, name)
        setattr(self, name, df)
        return df
