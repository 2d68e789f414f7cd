"""Aggregations (A1-A15) beyond a plain ``groupBy().agg()``.

All of them are single hash aggregates with a map-side partial step, so a
key holding a large share of the rows is combined inside each map task
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def conditional_sum(value, cond: Column) -> Column:
    """A2 ``sum(if(cond, value, 0))``."""
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(0)))


def signed_sum(value, sign_cond: Column) -> Column:
    """A2 ``sum(case when <cond> then q else -q end)``."""
    v = _c(value)
    return F.sum(F.when(sign_cond, v).otherwise(-v))


def exact_sums(df: DataFrame, group: Sequence[str], sums: Mapping[str, Column], scale: int = 2) -> DataFrame:
    """Exact decimal sums at the cost of long arithmetic.

    Values are cut to ``scale`` decimals exactly as a decimal cast does,
    summed as integer units per (group, input partition) -- the map-side
    work, in long arithmetic -- and the few partials per group are then
    added as ``decimal(38,0)``.  A partial covers one input split only, so it
    cannot overflow a long; the result is ``decimal(38, scale)`` and equals
    ``sum(cast(x as decimal(p, scale)))``.  Meant for low-cardinality
    groupings (reports, pivots): for a high-cardinality key the extra
    per-partition stage would double the shuffled rows."""
    unit = 10 ** scale
    units = {n: (c.cast(f"decimal(18,{scale})") * F.lit(unit)).cast("bigint") for n, c in sums.items()}
    partial = df.groupBy(*group, F.spark_partition_id().alias("__part")).agg(
        *[F.sum(v).alias(n) for n, v in units.items()])
    return partial.groupBy(*group).agg(*[
        (F.sum(F.col(n).cast("decimal(38,0)")) / F.lit(unit)).cast(f"decimal(38,{scale})").alias(n) for n in sums])


def pivot_measures(df: DataFrame, group: Sequence[str], pivot_col: str, values: Sequence,
                   measures: Mapping[str, Column], totals: bool = True, money_scale: int | None = None) -> DataFrame:
    """A3: two (or more) measures x explicit key values, plus totals, in one
    aggregate.  Explicit values avoid the extra job Spark's ``pivot`` runs
    to discover them; column ``<measure>_<value>`` per pair.  With
    ``money_scale`` the sums are exact decimals computed by
    :func:`exact_sums`."""
    cols = {}
    for v in values:
        for name, m in measures.items():
            cols[f"{name}_{v}"] = F.when(F.col(pivot_col) == F.lit(v), m)
    if totals:
        for name, m in measures.items():
            cols[f"{name}_total"] = m
    if money_scale is not None:
        return exact_sums(df, group, cols, money_scale)
    return df.groupBy(*group).agg(*[F.sum(c).alias(n) for n, c in cols.items()])


def period_totals(df: DataFrame, group: Sequence[str], date_col: str, value, as_of) -> DataFrame:
    """Year-, month- and cumulative-to-date totals to ``as_of`` in one
    pass (one scan, one shuffle) instead of three joined sub-results."""
    d = F.col(date_col).cast("date")
    a = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of
    upto = d <= a
    return df.filter(upto).groupBy(*group).agg(
        conditional_sum(value, d >= F.trunc(a, "year")).alias("ytd"),
        conditional_sum(value, d >= F.trunc(a, "month")).alias("mtd"),
        F.sum(_c(value)).alias("cumulative"),
    )


def max_lengths(df: DataFrame, cols: Sequence[str] | None = None, byte_length: bool = True) -> DataFrame:
    """One aggregate over all string columns: ``max(length(c))``,
    null -> 0.  Byte length by default (the target limits are in bytes)."""
    if cols is None:
        cols = [c for c, t in df.dtypes if t == "string"]
    fn = F.octet_length if byte_length else F.length
    return df.agg(*[F.coalesce(F.max(fn(F.col(c))), F.lit(0)).cast("long").alias(c) for c in cols])


def field_maxima(df: DataFrame, fields: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """``max(field)`` for every present field, one aggregate."""
    present = [f for f in fields if f in df.columns]
    aggs = [F.count(F.lit(1)).alias("row_count")] + [F.max(f).alias(f"max_{f}") for f in present]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


#: Size of the distinct-count sketches (log2 of their registers) and the
#: relative error that holds for six standard deviations.
SKETCH_LG = 14
SKETCH_BOUND = 6 * 1.04 / (1 << SKETCH_LG // 2)


def distinct_sketches(df: DataFrame, group: Sequence[str | Column], value: str) -> DataFrame:
    """A15, to be stored: one sketch of the distinct values per group (a
    table and day, a month); null values are not counted."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(value, F.lit(SKETCH_LG)).alias("sketch"))


def merged_distinct(sketches: DataFrame, group: Sequence[str | Column], out: str = "distinct_values") -> DataFrame:
    """Distinct counts over coarser groups from stored sketches alone: the
    rows behind them are not read again, and a value that several groups
    share counts once."""
    return sketches.groupBy(*group).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def having_count(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """A7 ``group by keys having count(*) >= min_count``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def two_level(parts: Sequence[DataFrame], inner_keys: Sequence[str], outer_keys: Sequence[str],
              measure: str, top: str | None = None) -> DataFrame:
    """A10: aggregate a union of sources, then aggregate again on coarser
    keys; ``top`` names the greatest inner group's measure."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    inner = u.groupBy(*inner_keys).agg(F.sum(measure).alias(measure))
    extra = [F.max(measure).alias(top)] if top else []
    return inner.groupBy(*outer_keys).agg(F.sum(measure).alias(measure), F.count(F.lit(1)).alias("groups"), *extra)
