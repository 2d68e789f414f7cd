"""Table changes (D1-D15).  Plain Parquet has no MERGE/UPDATE, so every
operator returns a NEW DataFrame that the caller writes (overwrite of a
table or partition); writing it is also what cuts the lineage.

Key-based changes join on the key columns only, so both sides are
hash-partitioned on the key; the source is de-duplicated with a grouped
``max(struct(...))`` -- an aggregate with a map-side partial step -- so a
key repeated many times in the source is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareshift.operators.joins import lookup_join


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest ``order_by`` values win (e.g. the
    highest ``version``); remaining ties go to the greatest full row, so the
    pick is deterministic."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    fields = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)] + [F.col(c) for c in rest]
    return df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__s")).select(
        *keys, *[F.col(f"__s.{c}").alias(c) for c in rest]
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
           order_by: Sequence[str] = ()) -> DataFrame:
    """Insert source rows with new keys; on a key clash overwrite only
    ``update_cols`` (all non-key source columns when None).  Duplicate
    source keys keep the greatest ``order_by`` row (H3).

    Two joins instead of one full outer join, which Spark cannot broadcast:
    a left join overwrites, a left-anti join finds the new keys, so a small
    source is broadcast and the target is not shuffled."""
    keys = list(keys)
    src = dedupe_latest(source, keys, order_by)
    if update_cols is None:
        update_cols = [c for c in src.columns if c not in keys]
    renamed = src.select(*[F.col(c).alias(f"__s_{c}") for c in src.columns]).withColumn("__s", F.lit(True))
    changed = lookup_join(target, renamed, keys, [f"__s_{k}" for k in keys], "left")
    kept = changed.select(*[
        F.when(F.col("__s").isNotNull(), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)
        if c in update_cols and c in src.columns and c not in keys else F.col(c) for c in target.columns])
    known = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys])
    new = src.join(known, [src[k] == known[f"__t_{k}"] for k in keys], "left_anti")
    types = dict(target.dtypes)
    added = new.select(*[F.col(c) if c in src.columns else F.lit(None).cast(types[c]).alias(c) for c in target.columns])
    return kept.unionByName(added)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str],
                order_by: Sequence[str] = (), unique_source: bool = False,
                split_hot_keys: bool = True) -> DataFrame:
    """D3: overwrite ``cols`` of matched target rows with the source values.
    A null in the source overwrites too (match flag, not coalesce).
    ``unique_source=True`` skips the de-duplication when the source keys are
    unique by construction (e.g. the source is itself keyed by them).  A
    target key holding a third of the rows is split over several join tasks
    (:func:`~wareshift.operators.joins.lookup_join`); pass
    ``split_hot_keys=False`` for a target bucketed by the keys."""
    keys = list(keys)
    picked = source.select(*keys, *[c for c in cols if c not in keys], *[
        o for o in order_by if o not in keys and o not in cols])
    src = picked if unique_source else dedupe_latest(picked, keys, order_by)
    s = src.select(*[F.col(k).alias(f"__s_{k}") for k in keys],
                   *[F.col(c).alias(f"__s_{c}") for c in cols]).withColumn("__m", F.lit(True))
    j = lookup_join(target, s, keys, [f"__s_{k}" for k in keys], "left", split_hot_keys)
    out = []
    for c in target.columns:
        if c in cols:
            out.append(F.when(F.col("__m").isNotNull(), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    extra = [F.col(f"__s_{c}").alias(c) for c in cols if c not in target.columns]
    return j.select(*out, *extra)


def update_by_case(df: DataFrame, id_col: str, col: str, mapping: Mapping, spark=None) -> DataFrame:
    """Per-id CASE, ELSE unchanged.  The mapping is a literal of known
    size, so it is broadcast."""
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.getActiveSession()
    dtype = dict(df.dtypes)
    m = spark.createDataFrame([(k, v) for k, v in mapping.items()], f"{id_col} {dtype[id_col]}, {col} {dtype[col]}")
    return update_from(df, F.broadcast(m), [id_col], [col])


def update_where(df: DataFrame, cond: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Conditional update (``SET c = v WHERE cond``), also soft delete
    (``is_removed = true``) and column copy (``F.col('other')``)."""
    cols = {c: F.when(cond, v).otherwise(F.col(c)) for c, v in assignments.items()}
    return df.withColumns(cols)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of every hashable column: the last sort key of ordered
    numbering.  The range partitioner cuts on the whole sort key, so with
    it a hot leading value (a third of the rows on one key) is spread over
    many range partitions instead of landing in one task, and rows that
    differ get the same order on every run."""
    cols = [F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]
    return F.xxhash64(*cols) if cols else F.lit(0)


def with_sequence(df: DataFrame, name: str = "seq_id", start: int = 1,
                  order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Dense, gap-free ids without a global window.

    Rows are (optionally) range-sorted -- on ``order_by`` and then a row
    hash, so ties on a hot key still split across tasks -- tagged with their partition id and
    position inside the partition, and that tagged frame is checkpointed to
    the shared checkpoint folder so a recomputation after a lost executor
    sees the same partitioning.  Per-partition counts (one row per
    partition) give the offsets, which are broadcast back."""
    from wareshift.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    base = df.sort(*order_by, row_hash(df)) if order_by else df
    tagged = base.select(
        "*",
        F.spark_partition_id().alias("__pid"),
        (F.monotonically_increasing_id() - (F.spark_partition_id().cast("long") * (1 << 33))).alias("__pos"),
    ).checkpoint(eager=True)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window

    # One row per partition: an un-partitioned window over this tiny frame is fine.
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = tagged.join(F.broadcast(offsets), "__pid").withColumn(
        name, F.lit(start) + F.col("__off") + F.col("__pos")
    )
    return out.drop("__pid", "__pos", "__off")


def sparse_ids(df: DataFrame, name: str = "seq_id") -> DataFrame:
    """D6 sparse form: unique, increasing per partition, not dense.  Each
    partition is sorted by row hash first (no shuffle), so a partition
    recomputed after a lost executor -- a shuffle output arrives in any
    order -- gives every row the same id again."""
    return df.sortWithinPartitions(row_hash(df)).withColumn(name, F.monotonically_increasing_id())


def delete_keys(df: DataFrame, doomed: DataFrame, keys: Sequence[str], split_hot_keys: bool = True) -> DataFrame:
    """Delete by key (a hot key of ``df`` stays splittable, see
    :func:`~wareshift.operators.joins.lookup_join`)."""
    d = doomed.select(*[F.col(k).alias(f"__d_{k}") for k in keys])
    return lookup_join(df, d, keys, [f"__d_{k}" for k in keys], "left_anti", split_hot_keys)


def reset_in_buckets(df: DataFrame, cond: Column, col: str, key: str, n: int = 8) -> DataFrame:
    """Reset ``col`` to null where ``cond``, with the bucket ``key % n``
    of each row (:func:`reset_slices` writes a stored table by bucket)."""
    out = update_where(df, cond, {col: F.lit(None).cast(dict(df.dtypes)[col])})
    return out.withColumn("bucket", F.pmod(F.col(key), F.lit(n)))


def write_slices(df: DataFrame, path: str, key: str, n: int = 8) -> None:
    """Store a table in ``n`` slices by ``key % n`` (column ``bucket``), for
    :func:`reset_slices`; a null key is in slice -1."""
    bucket = F.coalesce(F.pmod(F.col(key), F.lit(n)), F.lit(-1)).cast("int")
    df.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(path)


def reset_slices(spark: SparkSession, path: str, cond: Column, col: str) -> list[int]:
    """D8 on a stored table: set ``col`` to null where ``cond``, one write
    that replaces only the slices holding a row to change.  The others'
    files are not touched.  The new files are staged and take the slices'
    places, one after another, at the commit; a job lost before has changed
    nothing, and a rerun finds only what is left to change.  Returns the
    slices."""
    table = spark.read.parquet(path)
    todo = table.filter(cond & F.col(col).isNotNull()).select("bucket").distinct().collect()  # at most the slices
    slices = sorted(r.bucket for r in todo)
    if slices:
        changed = update_where(table.filter(F.col("bucket").isin(slices)), cond,
                               {col: F.lit(None).cast(dict(table.dtypes)[col])})
        changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return slices


def mark_saved(df: DataFrame, done: DataFrame, key: str, flag: str = "saved",
               split_hot_keys: bool = True) -> DataFrame:
    """Flag rows whose key is in ``done`` (a semi-join flag; ``done`` is
    made distinct so rows are never multiplied)."""
    hits = done.select(F.col(key).alias("__hk")).distinct().withColumn("__hit", F.lit(True))
    prior = F.coalesce(F.col(flag), F.lit(False)) if flag in df.columns else F.lit(False)
    j = lookup_join(df, hits, [key], ["__hk"], "left", split_hot_keys)
    return j.withColumn(flag, prior | F.col("__hit").isNotNull()).drop("__hit", "__hk")


def unmark_unsaved(df: DataFrame, cond: Column, flag: str = "saved") -> DataFrame:
    """D9 reverse: put back processed-but-unsaved rows."""
    return update_where(df, cond, {flag: F.lit(False)})


def null_reasons(cols: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in cols]))


def enforce_not_null(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected); rejected rows carry the reasons instead of
    being lost silently."""
    r = null_reasons(cols)
    good = df.filter(F.size(r) == 0)
    bad = df.withColumn("reject_reason", F.array_join(r, ", ")).filter(F.col("reject_reason") != "")
    return good, bad


def quarantine_dates(df: DataFrame, raw: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Parsed column ``out`` (junk -> null) plus the junk rows."""
    from wareshift.functions.scalars import is_junk_timestamp, lenient_timestamp

    parsed = df.withColumn(out, lenient_timestamp(raw))
    return parsed, df.filter(is_junk_timestamp(raw))


def chunk_rows(df: DataFrame, path: str, n: int = 1000, fmt: str = "parquet") -> None:
    """At most ``n`` rows per written file (insert batch cap)."""
    df.write.mode("overwrite").option("maxRecordsPerFile", n).format(fmt).save(path)


def truncate_table(spark, path: str, fmt: str = "parquet") -> None:
    """Keep the schema, drop all rows."""
    df = spark.read.format(fmt).load(path)
    empty = spark.createDataFrame([], df.schema)
    empty.write.mode("overwrite").format(fmt).save(path)


def analyze_table(spark, table: str) -> DataFrame:
    """Collect table and column statistics for the optimiser."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.sql(f"DESCRIBE EXTENDED {table}")


def add_version(df: DataFrame, changed: Column, col: str = "version") -> DataFrame:
    """Not-null version column, advanced on changed rows only."""
    base = F.coalesce(F.col(col), F.lit(0)).cast("long") if col in df.columns else F.lit(0).cast("long")
    return df.withColumn(col, F.when(changed, base + 1).otherwise(base))


def upsert_lookup(old: DataFrame, new: DataFrame, natural_keys: Sequence[str], id_col: str,
                  keep_cols: Sequence[str] = (), order_by_extra: Sequence[str] = ()) -> DataFrame:
    """New rows looked up in old ones by natural key: keep the old id
    (and ``keep_cols``, e.g. created/order), else assign the next ids after
    the current maximum (dense, ordered by the natural key)."""
    nk = list(natural_keys)
    o = dedupe_latest(old.select(*nk, id_col, *keep_cols), nk).select(
        *[F.col(k).alias(f"__nk_{k}") for k in nk], F.col(id_col).alias("__old_id"),
        *[F.col(c).alias(f"__old_{c}") for c in keep_cols])
    j = lookup_join(new, o, nk, [f"__nk_{k}" for k in nk], "left").drop(*[f"__nk_{k}" for k in nk])
    matched = j.filter(F.col("__old_id").isNotNull())
    fresh = with_sequence(j.filter(F.col("__old_id").isNull()), "__seq", 1, order_by=nk + list(order_by_extra))
    top = old.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__max"))  # one row
    fresh = fresh.crossJoin(F.broadcast(top)).withColumn("__old_id", F.col("__max") + F.col("__seq")).drop(
        "__seq", "__max")
    both = matched.unionByName(fresh)
    cols = [c for c in new.columns if c != id_col and c not in keep_cols]
    return both.select(
        F.col("__old_id").alias(id_col),
        *[F.coalesce(F.col(f"__old_{c}"), F.col(c)).alias(c) if c in new.columns else F.col(f"__old_{c}").alias(c)
          for c in keep_cols],
        *cols,
    )
