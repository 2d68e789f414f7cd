"""Latest row per key, pages and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareshift.operators.changes import with_sequence


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """``row_number() over (partition by keys order by o1 desc, ...) = 1``.

    Written as a grouped ``max(struct(o1, o2, ..., row))`` rather than a
    window: the window sorts every row of a key in one task, so a key with a
    third of the rows becomes one giant task; the aggregate keeps one
    candidate per key per map task (partial aggregation) and stays skew-safe.
    The remaining columns break ties, so the choice is deterministic --
    callers wanting a specific tie-break put it last in ``order_desc``."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    fields = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order_desc)] + [F.col(c) for c in rest]
    return df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__s")).select(
        *keys, *[F.col(f"__s.{c}").alias(c) for c in rest]
    )


#: Up to this many rows, skipped ones included, a page is each task's first
#: rows merged by the driver; beyond, sorted ranges are counted.
MERGED_ROWS = 10_000


def page(df: DataFrame, order: Sequence[Column | str], limit: int | None = None, offset: int = 0) -> DataFrame:
    """Ordered page; ``limit=None`` is offset without limit.

    A page that starts deep, or has no end, is cut without a task that holds
    all rows: the rows are range-sorted and numbered by the counts of the
    ranges before theirs (:func:`~wareshift.operators.changes.with_sequence`),
    and each range drops what lies outside the page.  The result keeps the
    ranges' order."""
    if limit is not None and offset + limit <= MERGED_ROWS:
        out = df.orderBy(*order)
        return (out.offset(offset) if offset else out).limit(limit)
    if not offset and limit is None:
        return df.orderBy(*order)
    place = F.col("__place")
    numbered = with_sequence(df, "__place", 0, order_by=list(order))
    inside = place >= offset if limit is None else (place >= offset) & (place < offset + limit)
    return numbered.filter(inside).drop("__place")


def keyset_page(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """``key > after order by key limit n`` (TakeOrderedAndProject: each
    task keeps its own top n, the driver merges n x tasks rows)."""
    return df.filter(F.col(key) > F.lit(after)).orderBy(key).limit(n)


def top_k_and_rest(df: DataFrame, measure: str, k: int, tie: str) -> tuple[DataFrame, DataFrame]:
    """T5: the k largest rows and everything else (anti-join on ``tie``,
    which must be unique)."""
    top = df.orderBy(F.col(measure).desc(), F.col(tie)).limit(k)
    rest = df.join(top.select(tie), tie, "left_anti")
    return top, rest
