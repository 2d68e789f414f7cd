"""Tables written between the steps of an operator.

They lie in the shared folder of ``spark.checkpoint.dir``, so a later step
reads files instead of recomputing lost partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wareshift.session import ensure_checkpoint_dir, scratch_path


#: Rows of a few numbers that one file of a narrow table holds, about.
ROWS_A_FILE = 1_000_000


def written(df: DataFrame, name: str, compression: str = "snappy", rows: int | None = None) -> DataFrame:
    """Write a frame to a fresh folder and read it back.  For a narrow table
    of about ``rows`` rows the last step runs in as many tasks as the files
    that they fill, not one per shuffle partition."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    (df if rows is None else df.coalesce(-(-rows // ROWS_A_FILE) + 1)).write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
