"""Sequences that live across runs, sketches that merge, keys, needles, slices."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wareshift.functions import rules as RU
from wareshift.operators import aggregates as A
from wareshift.operators import changes as D
from wareshift.operators import querylog as L
from wareshift.operators import schema as SC
from wareshift.sources import sequences as SQ


def _ids(spark, path, rows, batch, **options):
    df = spark.createDataFrame([(r,) for r in rows], "v string").repartition(3)
    return {r.v: r.seq_id for r in SQ.with_stored_sequence(df, path, "s", batch, order_by=["v"], **options).collect()}


def test_two_runs_and_a_replay_share_no_id(spark, tmp):
    path = os.path.join(tmp, "seq")
    one = _ids(spark, path, ["b", "a", "c"], "d1", start=10)
    assert one == {"a": 10, "b": 11, "c": 12}
    two = _ids(spark, path, ["z", "a"], "d2", start=10)
    assert two == {"a": 13, "z": 14}
    assert _ids(spark, path, ["c", "b", "a"], "d1", start=10) == one  # replay: the same ids
    assert SQ.reserve(spark, path, "other", "d1", 5) == 1  # sequences do not meet
    assert _ids(spark, path, ["y"], "d3") == {"y": 15}
    assert SQ.reserve(spark, path, "s", "none", 0) == 16 and SQ.reserve(spark, path, "s", "d4", 2) == 16
    blocks = sorted((r.first, r.n) for r in SQ.reservations(spark, path).filter("sequence = 's'").collect())
    assert blocks == [(10, 3), (13, 2), (15, 1), (16, 2)]


def test_a_batch_that_failed_after_reserving_keeps_its_block(spark, tmp):
    path = os.path.join(tmp, "seq")
    assert SQ.reserve(spark, path, "s", "d1", 100) == 1  # and then its write fails
    assert _ids(spark, path, ["a"], "d2") == {"a": 101}
    assert _ids(spark, path, ["p", "q"], "d1") == {"p": 1, "q": 2}
    with pytest.raises(ValueError, match="not the same batch"):
        SQ.reserve(spark, path, "s", "d2", 2)


def test_sketches_merge_without_the_rows(spark, tmp):
    df = spark.range(60000).select((F.col("id") % 60).alias("day"), ((F.col("id") * 7919) % 20011).alias("user"))
    A.distinct_sketches(df, ["day"], "user").write.parquet(os.path.join(tmp, "s"))
    stored = spark.read.parquet(os.path.join(tmp, "s"))
    merged = A.merged_distinct(stored.withColumn("month", F.floor(F.col("day") / 30)), ["month"])
    exact = {r.m: r.n for r in df.groupBy(F.floor(F.col("day") / 30).alias("m")).agg(F.count_distinct("user").alias("n")).collect()}
    got = {r.month: r.distinct_values for r in merged.collect()}
    assert got.keys() == exact.keys() and all(abs(got[m] - n) <= A.SKETCH_BOUND * n for m, n in exact.items())
    assert A.SKETCH_BOUND < 0.06
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "user" not in plan


def test_unique_keys(spark):
    rows = [(i, i // 2, i % 2, None if i == 7 else i, 5) for i in range(5000)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d long, e long").repartition(4)
    near = df.unionByName(df.filter("a = 17"))  # one duplicate among 5001 rows: the estimate cannot see it
    cands = [["a"], ["b"], ["b", "c"], ["d"], ["e"], ["a", "e"]]
    assert SC.unique_keys(df, cands) == [True, False, True, True, False, True]
    assert SC.unique_keys(near, cands) == [False] * 6
    nulls = df.unionByName(df.filter("a = 7").withColumn("a", F.lit(9999).cast("long")))
    assert SC.unique_keys(nulls, [["d"], ["a"]]) == [False, True]  # two nulls are one key
    assert SC.unique_keys(df.limit(0), [["a"]]) == [True]
    assert SC.unique_keys(df, [["b"]]) == [False]


def _classified(sql, err):
    f = {"sql": (sql or "").lower(), "err": (err or "").lower()}
    for cat, groups in RU.ERROR_RULES:
        if all(any(n in f[field] for n in needles) for field, needles in groups):
            return cat
    return RU.DEFAULT_CATEGORY


PIECES = sorted({n for _, g in RU.ERROR_RULES for _, ns in g for n in ns} | {"", "ins", "table", "ta", " ", "x_", "___", "full", "outer join"})


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.lists(st.sampled_from(PIECES), max_size=5).map("".join))] * 2), min_size=1, max_size=12))
def test_needles_glued_together_equal_the_rule_chain(spark, pairs):
    df = spark.createDataFrame(pairs, "sql string, err string")
    assert [r[0] for r in df.select(L.classify_error("sql", "err")).collect()] == [_classified(s, e) for s, e in pairs]


def test_overlapping_needles_are_all_found(spark, monkeypatch):
    rules = [("both", [("err", ["abcd"]), ("err", ["cde"]), ("err", ["ab"])]), ("short", [("err", ["ab"])]), ("mid", [("err", ["bc"])])]
    monkeypatch.setattr(RU, "ERROR_RULES", rules)
    df = spark.createDataFrame([("abcde",), ("abx",), ("xbc",), ("cde",), ("",), (None,)], "err string")
    got = [r[0] for r in df.select(L.classify_error(F.lit(""), "err")).collect()]
    assert got == ["both", "short", "mid", RU.DEFAULT_CATEGORY, RU.DEFAULT_CATEGORY, RU.DEFAULT_CATEGORY]


def test_classification_searches_each_text_once(spark):
    df = spark.createDataFrame([("a", "b")], "sql string, err string").select(L.classify_error("sql", "err").alias("c"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2 and "Contains" not in plan
    noise = df.sparkSession.createDataFrame([("a",)], "t string").select(L.is_noise("t").alias("n"))
    assert noise._jdf.queryExecution().executedPlan().toString().count("RLIKE") <= 1


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def test_reset_writes_only_the_slices_that_change(spark, tmp):
    path = os.path.join(tmp, "t")
    rows = [(i if i != 50 else None, "0115" if i % 8 in (2, 5) else "0116", 1 if i % 3 else None) for i in range(200)]
    D.write_slices(spark.createDataFrame(rows, "order_id long, sql_date string, execute_result int"), path, "order_id", 8)
    before = _files(path)
    assert L.reset_run_slices(spark, path, "0115") == [-1, 2, 5]
    after = _files(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in before if f not in kept} == {-1, 2, 5}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in kept} == {0, 1, 3, 4, 6, 7}
    got = sorted(((r.order_id, r.sql_date, r.execute_result) for r in spark.read.parquet(path).collect()), key=str)
    assert got == sorted(((i, d, None if d == "0115" else r) for i, d, r in rows), key=str)
    assert L.reset_run_slices(spark, path, "0115") == [] and _files(path) == after  # nothing left to do
