"""Mixing sources to target weights by systematic sampling.

Every source gets a target of words: its weight's share of ``share`` times
all words, no more than ``cap`` times its own, the excess reshared by weight
among the others.  Within a source each document expects
``target / source_size`` copies.  The expected copies are prefix-summed in
order of size, one random offset is added per source, and a document is
emitted once per integer the sum crosses, so its copies are the expected
number rounded down or up.  In order of size the taken words of a source
differ from its target by less than its largest document.

Plan: the rows are dealt by ranges of (source, size, id) and written sorted;
a row's place in its source is its place in its part plus the rows of that
source in earlier parts, from a table with one row per part and source.  A
hot source is spread over many parts.  The offset comes from a hash of the
seed and the source, so reruns agree.

Defined results: a null or empty text has size 0; a null source is a source
of its own, last in order; rows of a source without words take no words
(expected copies 0); repeated rows are documents of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareshift.llm.stage import written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text as bigint; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """source, source_size, target from rows (source, size).

    The excess that sources above their cap give back settles at a level
    ``min(cap * size, level * weight)``; the level is found over the sources
    in order of cap * size / weight, each row testing the level that holds
    if all rows before it are capped.  One row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    per = per.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
                         .cast("bigint"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    per = (per.withColumn("all_words", F.sum("source_size").over(everything))
           .withColumn("all_w", F.sum("w").over(everything))
           .withColumn("left_words", F.lit(float(share)) * F.col("all_words")
                       - F.lit(float(cap)) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
           .withColumn("left_w", F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0)))
           .withColumn("capped", F.lit(float(cap)) * F.col("source_size") * F.col("left_w")
                       <= F.col("left_words") * F.col("w")))
    # the first row that is not capped sets the level for itself and all after it
    first_open = Window.orderBy("capped", F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    whole = first_open.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("words", F.first("left_words").over(whole)).withColumn("of_w", F.first("left_w").over(whole)))
    target = F.when(F.col("capped"), F.lit(float(cap)) * F.col("source_size")).otherwise(
        F.col("words") * F.col("w") / F.col("of_w"))
    return per.select("source", "source_size", target.alias("target"))


def plan_mix(docs: DataFrame, carry: list[str], weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
             cap: float = 2.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One row per document: ``row`` (struct of the ``carry`` columns), size,
    source_size, target, copies."""
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), source.alias("source"),
        word_count(text).alias("size"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("tie"))
    order = ["source", "size", "id", "tie"]
    placed = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
        .drop("id", "tie"), "mix")
    targets = source_targets(placed.select("source", "size"), weights, share, cap)
    runs = placed.groupBy("source", "part").agg(F.count("*").alias("n"), F.min("place").alias("from_place"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("rows_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), "source"),
                                                                            F.lit("null")))), 1, 8), 16, 10)
    of_run = (runs.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
              .select(F.col("s").alias("run_source"), F.col("part").alias("run_part"), "from_place", "rows_before",
                      "source_size", "target", (offset.cast("double") / F.lit(4294967296.0)).alias("offset")))
    rank = F.col("rows_before") + F.col("place") - F.col("from_place") + 1

    def crossed(k: Column) -> Column:
        whole = F.floor(F.col("offset") + k.cast("double") * F.col("target") / F.col("source_size"))
        return F.when(F.col("source_size") > 0, whole).otherwise(F.lit(0).cast("bigint"))

    joined = placed.join(of_run, F.col("source").eqNullSafe(F.col("run_source")) & (F.col("part") == F.col("run_part")))
    return joined.select("row", "size", "source_size", "target", (crossed(rank) - crossed(rank - 1)).alias("copies"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each with all its columns, once per copy."""
    plan = plan_mix(docs, docs.columns, **options)
    once = plan.where("copies > 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
