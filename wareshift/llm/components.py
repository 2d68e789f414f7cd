"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareshift.llm.stage import written
from wareshift.operators.joins import lookup_join


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b), a written table;
    component being its smallest node.

    Alternates hooking every larger neighbour to the smallest neighbour with
    hooking every smaller neighbour to it, until nothing changes (a number of
    rounds that grows with the logarithm of a path).  Each round is an
    aggregate of minima and a lookup of the node's minimum, in which a node
    with very many neighbours is split over tasks; the edge list is written,
    a file per million edges, so neither lineage nor memory grows.
    """
    n = edges.count()
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges", rows=n)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("n"), F.least("a", "low").alias("low"))
        large = lookup_join(both, lowest, ["a"], ["n"], "inner").where("b > a").select(
            F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        below = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), "low")
        small = lookup_join(large, below, ["a"], ["n"], "inner").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        now = written(small.where("a <> b").distinct(), "edges", rows=n)
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state.n, state.h) == seen:
            break
        seen = (state.n, state.h)
    # every edge now leads to its component's smallest node
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
