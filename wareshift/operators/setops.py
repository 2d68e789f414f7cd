"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_union(parts: Mapping[str, DataFrame], measures: Sequence[str], tag: str = "kind",
                 fill=0) -> DataFrame:
    """Align measures across parts with zero fill and a type tag."""
    out = None
    for name, df in parts.items():
        cols = [F.lit(name).alias(tag)] + [c for c in df.columns if c not in measures]
        for m in measures:
            cols.append(F.col(m) if m in df.columns else F.lit(fill).alias(m))
        aligned = df.select(*cols)
        out = aligned if out is None else out.unionByName(aligned, allowMissingColumns=True)
    return out


def names_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def names_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """U5 (one direction; call twice for both)."""
    return a.subtract(b)


def names_union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct()


def presence(a: DataFrame, b: DataFrame, keys: Sequence[str], left: str = "source",
             right: str = "target") -> DataFrame:
    """J16 two-sided presence diff: full join on keys with a ``side``
    column (``both`` / ``<left>_only`` / ``<right>_only``)."""
    l = a.select(*keys).distinct().withColumn("__a", F.lit(True))
    r = b.select(*keys).distinct().withColumn("__b", F.lit(True))
    j = l.join(r, list(keys), "full")
    side: Column = (
        F.when(F.col("__a").isNotNull() & F.col("__b").isNotNull(), F.lit("both"))
        .when(F.col("__a").isNotNull(), F.lit(f"{left}_only"))
        .otherwise(F.lit(f"{right}_only"))
    )
    return j.select(*keys, side.alias("side"))
