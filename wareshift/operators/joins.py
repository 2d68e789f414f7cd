"""Join operators.

Plain equi/outer/semi/anti joins are Spark's own; this module holds the
joins Spark has no direct operator for, re-expressed as equi-joins so the
planner can hash-partition both sides instead of falling back to a nested
loop:

* ``ancestor_join`` (J5): ``LEFT(c.path, LENGTH(p.path)) = p.path``.
* ``containment_join`` (J6): ``locate(p.path, c.path) > 0``.
* ``range_join`` (J3): equi key plus ``between`` bounds, intervals of any
  length.

Broadcasts are asked for only on sides with a bound: the set of distinct
path lengths (at most the longest path), one-row aggregates (gram sizes,
block levels) and a ``limit(1)`` row; any other side is left to the
planner's size-checked choice.  ``lookup_join`` keeps a
hot key of the big side splittable by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str], lookup_keys: Sequence[str],
                how: str = "left", split_hot_keys: bool = True) -> DataFrame:
    """Join ``df`` (big, keys possibly hot) with ``lookup`` (one row per
    key, typically the output of an aggregate on those keys).

    Spark would reuse the aggregate's hash partitioning for the lookup side,
    so only ``df`` is shuffled for a sort-merge join -- and then AQE cannot
    split a skewed partition, because it needs shuffle stages on BOTH sides.
    With ``split_hot_keys`` the keys are compared as one struct value: the
    planner shuffles both sides for the join itself, and a key holding a
    third of ``df`` is split over several tasks (the small lookup side is
    shuffled once more; a lookup side under the broadcast threshold is still
    broadcast).  Struct equality matches null fields, so null lookup keys
    are dropped first -- they never match under ``=`` anyway.  Pass
    ``split_hot_keys=False`` when ``df`` is already partitioned (bucketed)
    by the keys, to keep that co-location."""
    keys, lookup_keys = list(keys), list(lookup_keys)
    if not split_hot_keys:
        return df.join(lookup, [df[a] == lookup[b] for a, b in zip(keys, lookup_keys)], how)
    present = F.lit(True)
    for b in lookup_keys:
        present = present & F.col(b).isNotNull()
    lk = lookup.filter(present)
    cond = (F.struct(*[df[a].alias(f"k{i}") for i, a in enumerate(keys)])
            == F.struct(*[lk[b].alias(f"k{i}") for i, b in enumerate(lookup_keys)]))
    return df.join(lk, cond, how)


def _seg_prefixes(path: Column, sep: str) -> Column:
    """'a|b|c' -> ['a', 'a|b', 'a|b|c'] (prefixes at separator boundaries)."""
    parts = F.split(path, "\\" + sep if sep in ".|*+?()[]{}^$\\" else sep)
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), sep),
    )


def path_prefixes(df: DataFrame, path: str, out: str = "prefix", sep: str = "|",
                  lengths: DataFrame | None = None, length_col: str = "plen") -> DataFrame:
    """Expand each row into the prefixes of its path.

    Without ``lengths`` the prefixes end at separator boundaries (path
    semantics).  With ``lengths`` (one column of distinct prefix lengths,
    e.g. the lengths of all ancestor paths) the prefixes are raw string
    prefixes of exactly those lengths -- the textual ``LEFT(...)=...``
    semantics, in which ``1`` is a prefix of ``10``.
    """
    if lengths is None:
        return df.withColumn(out, F.explode(_seg_prefixes(F.col(path), sep)))
    # The length set is bounded by the longest path, so it is safe to broadcast.
    ls = F.broadcast(lengths.select(F.col(length_col).cast("int").alias("__len")).distinct())
    return (
        df.join(ls, F.col("__len") <= F.length(F.col(path)), "inner")
        .withColumn(out, F.substring(F.col(path), 1, F.col("__len")))
        .drop("__len")
    )


def ancestor_join(children: DataFrame, parents: DataFrame, child_path: str, parent_path: str,
                  keys: Sequence[str] = (), mode: str = "string", sep: str = "|") -> DataFrame:
    """Join every child to each parent whose path is a prefix of the
    child's path (and whose ``keys`` are equal).

    ``mode='string'`` reproduces ``LEFT(c.path, LENGTH(p.path)) = p.path``;
    ``mode='path'`` only matches whole segments.  Only the distinct (keys,
    path) pairs are expanded into prefixes and meet the parents; the rows
    join that result by their own path, so no other column of theirs is
    repeated per prefix.  Column names of the two sides must not clash
    except for ``keys``."""
    if mode not in ("string", "path"):
        raise ValueError(mode)
    names = [f"__c_{k}" for k in keys]
    distinct = children.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(child_path).alias("__path")).distinct()
    if mode == "string":
        lengths = parents.select(F.length(F.col(parent_path)).alias("plen")).distinct()
        exploded = path_prefixes(distinct, "__path", "__prefix", sep, lengths=lengths)
    else:
        exploded = path_prefixes(distinct, "__path", "__prefix", sep)
    # every child of a root shares the root's prefix: a hot join key, kept
    # splittable by AQE (see lookup_join)
    p = parents.withColumnsRenamed({k: f"__p_{k}" for k in keys})
    found = lookup_join(exploded, p, ["__prefix", *names], [parent_path, *[f"__p_{k}" for k in keys]], "inner").drop(
        "__prefix", *[f"__p_{k}" for k in keys])
    return lookup_join(children, found, [child_path, *keys], ["__path", *names], "inner").drop("__path", *names)


def ancestor_rollup(facts: DataFrame, path: str, measures: dict[str, Column], parents: DataFrame,
                    parent_path: str, keys: Sequence[str] = (), mode: str = "string", sep: str = "|",
                    leaf_unique: bool = False) -> DataFrame:
    """Sum measures of all descendants for every ancestor.

    Facts are aggregated per distinct (keys, path) first, so the prefix
    expansion works on one row per path instead of one per fact, and the
    root prefix (which every row shares) is combined map-side before the
    shuffle.  ``leaf_unique=True`` says the facts already hold one row per
    (keys, path) with the measure columns named as in ``measures``, and
    skips that step (one shuffle less)."""
    if leaf_unique:
        leaf = facts.select(*keys, path, *measures)
    else:
        leaf = facts.groupBy(*keys, path).agg(*[e.alias(n) for n, e in measures.items()])
    if mode == "string":
        lengths = parents.select(F.length(F.col(parent_path)).alias("plen")).distinct()
        ex = path_prefixes(leaf, path, "__prefix", sep, lengths=lengths)
    else:
        ex = path_prefixes(leaf, path, "__prefix", sep)
    rolled = ex.groupBy(*keys, "__prefix").agg(*[F.sum(n).alias(n) for n in measures])
    on = [rolled["__prefix"] == parents[parent_path]] + [rolled[k] == parents[k] for k in keys]
    out = parents.join(rolled, on, "left")
    for k in keys:
        out = out.drop(rolled[k])
    return out.drop("__prefix")


#: Characters of the grams that the containment index is built on.
GRAM = 3


def _grams(text: Column, size: Column) -> Column:
    """Distinct substrings of ``size`` characters; size 0 gives ''."""
    n = F.length(text)
    return F.when(size == 0, F.array(F.lit(""))).when(n >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.substring(text, i, size)))).otherwise(
        F.array().cast("array<string>"))


def contained_pairs(children: DataFrame, parents: DataFrame, child_path: str, parent_path: str,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Distinct (keys..., __child, __parent) with ``locate(parent, child) > 0``.

    An index on the rarest gram: every distinct parent path enters under the
    one of its three-character grams (shorter paths: the whole path) that the
    fewest child paths hold, a child looks up each of its distinct grams
    once, and ``locate`` verifies.  A child that contains a parent holds all
    the parent's grams, so nothing is missed, and a parent has one entry, so
    a pair comes once.  A child costs one row per distinct gram (its length
    at most), never one per substring; a parent with a gram that no child
    holds drops out before the lookups."""
    kc = [f"__k{i}" for i in range(len(keys))]
    c = children.select(*[F.col(k).alias(n) for k, n in zip(keys, kc)], F.col(child_path).alias("__child")).filter(
        F.col("__child").isNotNull()).distinct()
    p = parents.select(*[F.col(k).alias(n) for k, n in zip(keys, kc)], F.col(parent_path).alias("__parent")).filter(
        F.col("__parent").isNotNull()).distinct()
    size = F.least(F.lit(GRAM), F.length("__parent"))
    # the gram sizes in use: one row holding at most GRAM + 1 numbers
    sizes = p.agg(F.collect_set(size).alias("__sizes"))
    lookups = c.crossJoin(F.broadcast(sizes)).withColumn("__gram", F.explode(F.flatten(F.transform(
        "__sizes", lambda s: _grams(F.col("__child"), s))))).drop("__sizes")
    counts = lookups.groupBy(*kc, "__gram").agg(F.count(F.lit(1)).alias("__n"))
    entered = p.withColumn("__gram", F.explode(_grams(F.col("__parent"), size)))
    counts = counts.withColumnsRenamed({n: f"__n{n}" for n in kc}).withColumnRenamed("__gram", "__counted")
    rated = lookup_join(entered, counts, ["__gram", *kc], ["__counted", *[f"__n{n}" for n in kc]], "left")
    rarest = rated.groupBy(*kc, "__parent").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__gram")).alias("__r"))
    index = rarest.filter(F.col("__r.n") > 0).select(
        *[F.col(n).alias(f"__i{n}") for n in kc], F.col("__r.__gram").alias("__entry"), "__parent")
    met = lookup_join(lookups, index, ["__gram", *kc], ["__entry", *[f"__i{n}" for n in kc]], "inner")
    return met.filter(F.expr("locate(__parent, __child) > 0")).select(*kc, "__child", "__parent")


def containment_join(children: DataFrame, parents: DataFrame, child_path: str, parent_path: str,
                     keys: Sequence[str] = ()) -> DataFrame:
    """``locate(p.path, c.path) > 0`` within equal ``keys``: the rows of both
    sides joined through :func:`contained_pairs`."""
    kc = [f"__k{i}" for i in range(len(keys))]
    pairs = contained_pairs(children, parents, child_path, parent_path, keys)
    p = parents.withColumnsRenamed({k: f"__p_{k}" for k in keys})
    found = lookup_join(pairs, p, ["__parent", *kc], [parent_path, *[f"__p_{k}" for k in keys]], "inner").drop(
        "__parent", *[f"__p_{k}" for k in keys])
    return lookup_join(children, found, [child_path, *keys], ["__child", *kc], "inner").drop("__child", *kc)


def containment_count(children: DataFrame, parents: DataFrame, child_path: str, parent_path: str,
                      keys: Sequence[str] = (), out: str = "children") -> DataFrame:
    """Parents with the number of child rows whose path contains theirs
    (parents without any are left out).  Equal child paths are counted
    first and the pairs are summed where they arise: no row of either side
    is repeated per pair."""
    kc = [f"__k{i}" for i in range(len(keys))]
    weight = children.groupBy(*[F.col(k).alias(f"__w{i}") for i, k in enumerate(keys)], F.col(child_path).alias("__of")).agg(
        F.count(F.lit(1)).alias("__w"))
    pairs = contained_pairs(children, parents, child_path, parent_path, keys)
    weighed = lookup_join(pairs, weight, ["__child", *kc], ["__of", *[f"__w{i}" for i in range(len(keys))]], "inner")
    counted = weighed.groupBy(*kc, "__parent").agg(F.sum("__w").alias(out))
    return lookup_join(parents, counted, [parent_path, *keys], ["__parent", *kc], "inner").drop("__parent", *kc)


def contained_in_any(parents: DataFrame, children: DataFrame, parent_path: str, child_path: str,
                     keys: Sequence[str] = ()) -> DataFrame:
    """The parents whose path occurs in some child path of equal ``keys``."""
    kc = [f"__k{i}" for i in range(len(keys))]
    hit = contained_pairs(children, parents, child_path, parent_path, keys).select(*kc, "__parent").distinct()
    return lookup_join(parents, hit, [parent_path, *keys], ["__parent", *kc], "left_semi")


def _bucket_of(c: Column, width: float, dtype: str) -> Column:
    """Bucket number of a value: ``floor(v / width)``; dates and timestamps
    count in days (``width`` days per bucket).  Monotonic in the value; very
    large numbers share the outermost buckets."""
    if dtype == "date" or dtype.startswith("timestamp"):
        c = F.datediff(F.to_date(c), F.to_date(F.lit("1970-01-01")))
    edge = F.lit(float(1 << 52))
    return F.floor(F.least(F.greatest(c / F.lit(width), -edge), edge)).cast("long")


def dyadic_cover(lo: str, hi: str) -> Column:
    """The fewest aligned blocks ``[node << level, (node + 1) << level)``
    that make up the whole numbers from column ``lo`` to column ``hi``, as
    an array of (level, node); at most two a level, empty if hi < lo.

    At level k the part still open is ``[ceil(lo / 2**k), (hi + 1) >> k)``;
    its first block is taken where that start is odd, its last where that
    end is odd."""
    levels = "sequence(0, 54)"
    start = f"-shiftright(-{lo}, k)"
    end = f"shiftright({hi} + 1, k)"
    block = "struct(k AS level, {} AS node)".format
    return F.expr(f"""concat(
        transform(filter({levels}, k -> {start} < {end} AND ({start}) & 1 = 1), k -> {block(start)}),
        transform(filter({levels}, k -> {start} < {end} AND ({end}) & 1 = 1), k -> {block(end + ' - 1')}))""")


def range_join(facts: DataFrame, dims: DataFrame, keys: Sequence[str], value: str, lo: str, hi: str,
               how: str = "inner", bucket: float | None = None) -> DataFrame:
    """Equi key plus ``value between lo and hi``: a hash/sort-merge join on
    ``keys`` with the bounds as a residual condition.

    Without ``bucket`` every fact row is compared with every dimension row
    of its key before the bounds filter -- all pairs of a key, which for a
    hot key with many intervals is quadratic.  With ``bucket`` (the width of
    the finest buckets in the value's unit, days for dates and timestamps)
    an interval of any length, open-ended ones included, becomes the few
    aligned blocks of buckets that make it up (:func:`dyadic_cover`), and
    each distinct (key, value) of the facts looks up the blocks that hold
    its bucket, one per level in use.  It meets an interval in exactly one
    block, with the bounds checked there; the facts then join what their
    (key, value) met, so no fact row is repeated for the lookups.  Allowed
    for joins that keep the fact side: inner, left, left_semi, left_anti."""
    if bucket is None:
        cond = [facts[k] == dims[k] for k in keys] + [facts[value] >= dims[lo], facts[value] <= dims[hi]]
        out = facts.join(dims, cond, how)
        for k in keys:
            out = out.drop(dims[k])
        return out
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"bucketed range join keeps the fact side only, not {how!r}")
    ft, dt = dict(facts.dtypes), dict(dims.dtypes)
    points = facts.filter(F.col(value).isNotNull()).select(
        *[F.col(k).alias(f"__f_{k}") for k in keys], F.col(value).alias("__v")).distinct()
    points = points.withColumn("__fb", _bucket_of(F.col("__v"), bucket, ft[value]))
    blocks = dims.withColumnsRenamed({k: f"__d_{k}" for k in keys}).withColumns(
        {"__lo": _bucket_of(F.col(lo), bucket, dt[lo]), "__hi": _bucket_of(F.col(hi), bucket, dt[hi])})
    blocks = blocks.withColumn("__b", F.explode(dyadic_cover("__lo", "__hi"))).drop("__lo", "__hi")
    # the levels in use: one row holding at most 55 numbers
    levels = blocks.agg(F.collect_set("__b.level").alias("__levels"))
    probes = points.crossJoin(F.broadcast(levels)).withColumn("__level", F.explode("__levels")).withColumn(
        "__node", F.expr("shiftright(__fb, __level)")).drop("__levels", "__fb")
    met = probes.join(blocks, [F.col(f"__f_{k}") == F.col(f"__d_{k}") for k in keys]
                      + [F.col("__level") == F.col("__b.level"), F.col("__node") == F.col("__b.node"),
                         F.col("__v") >= F.col(lo), F.col("__v") <= F.col(hi)])
    met = met.drop("__level", "__node", "__b", *[f"__d_{k}" for k in keys])
    cond = [facts[k] == met[f"__f_{k}"] for k in keys] + [facts[value] == met["__v"]]
    out = facts.join(met, cond, how)
    return out.drop("__v", *[f"__f_{k}" for k in keys]) if how in ("inner", "left") else out


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``LEFT JOIN (... limit 1) ON 1=1``: attach a single row to all rows.
    The right side holds at most one row by construction, so broadcasting
    it is size-safe."""
    return df.join(F.broadcast(one_row.limit(1)), F.lit(True), "left")


def convert_units(facts: DataFrame, factors: DataFrame, key: str, factor: str, value: str,
                  out: str = "converted", split_hot_keys: bool = True, factor_out: str | None = None) -> DataFrame:
    """Divide by a de-duplicated conversion factor; 0 or null -> 1.
    ``factor_out`` keeps the factor used.  A unit shared by a third of the
    facts is split (see :func:`lookup_join`)."""
    f = factors.groupBy(F.col(key).alias("__fk")).agg(F.max(factor).alias("__f"))
    guarded = F.coalesce(F.when(F.col("__f") != 0, F.col("__f")), F.lit(1))
    j = lookup_join(facts, f, [key], ["__fk"], "left", split_hot_keys)
    j = j.withColumn(out, F.col(value) / guarded)
    if factor_out is not None:
        j = j.withColumn(factor_out, guarded)
    return j.drop("__f", "__fk")


def semi(df: DataFrame, sub: DataFrame, on, how: str = "left_semi") -> DataFrame:
    """J7 IN-subquery as a left-semi join (never multiplies rows)."""
    return df.join(sub, on, how)


def anti_not_in(df: DataFrame, sub: DataFrame, col: str, sub_col: str) -> DataFrame:
    """J8 null-aware ``NOT IN``: an empty sub-result qualifies every row, a
    null probe included; otherwise a null probe never qualifies, and when the
    sub-result holds a null nothing does."""
    nulls = sub.filter(F.col(sub_col).isNull()).limit(1).select(F.lit(1).alias("__null"))
    kept = lookup_join(df.filter(F.col(col).isNotNull()), sub.select(F.col(sub_col).alias("__k")).distinct(),
                       [col], ["__k"], "left_anti")
    kept = kept.join(F.broadcast(nulls), F.lit(True), "left_anti")
    any_row = sub.limit(1).select(F.lit(1).alias("__any"))
    unknown = df.filter(F.col(col).isNull()).join(F.broadcast(any_row), F.lit(True), "left_anti")
    return kept.unionByName(unknown)
