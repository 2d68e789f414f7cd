"""Skewed keys (one key with far more than a third of the rows) against
pandas brute force, and property tests of the text operators."""

import os
import string

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wareshift.functions import rules as RU
from wareshift.operators import changes as D
from wareshift.operators import joins as J
from wareshift.operators import querylog as L
from wareshift.operators import windows as W
from wareshift.sources import delimited as DL


def _skewed(spark, n=6000):
    # key 0 holds 2/3 of the rows
    rows = [(0 if i % 3 else i, i % 97, i) for i in range(n)]
    return spark.createDataFrame(rows, "k long, d long, v long").repartition(8), pd.DataFrame(rows, columns=["k", "d", "v"])


def test_latest_per_key_under_skew(spark):
    df, pdf = _skewed(spark)
    got = {r.k: (r.d, r.v) for r in W.latest_per_key(df, ["k"], ["d", "v"]).collect()}
    want = pdf.sort_values(["d", "v"]).groupby("k").tail(1)
    assert got == {r.k: (r.d, r.v) for r in want.itertuples()}


def test_upsert_and_dedupe_under_skew(spark):
    df, pdf = _skewed(spark)
    target = spark.createDataFrame([(0, -1, -1), (1, -1, -1), (99999, 5, 5)], "k long, d long, v long")
    out = {r.k: (r.d, r.v) for r in D.upsert(target, df, ["k"], order_by=["v"]).collect()}
    latest = pdf.sort_values("v").groupby("k").tail(1).set_index("k")
    assert out[0] == tuple(latest.loc[0, ["d", "v"]]) and out[99999] == (5, 5) and out[1] == (-1, -1)
    assert len(out) == pdf.k.nunique() + 2 - (1 if 1 in set(pdf.k) else 0)


def test_rollup_hot_root(spark):
    rows = [("r|a|%d" % (i % 50) if i % 4 else "r|b|%d" % i, 1) for i in range(4000)]
    facts = spark.createDataFrame(rows, "path string, v long").repartition(8)
    nodes = spark.createDataFrame([("r",), ("r|a",), ("r|b",)], "p string")
    got = {r.p: r.v for r in J.ancestor_rollup(facts, "path", {"v": F.sum("v")}, nodes, "p", mode="path").collect()}
    pdf = pd.DataFrame(rows, columns=["path", "v"])
    assert got == {p: int(pdf[(pdf.path == p) | pdf.path.str.startswith(p + "|")].v.sum()) for p in ["r", "r|a", "r|b"]}


FIELD = st.one_of(st.none(), st.just("\\N"), st.text(alphabet=st.sampled_from(list("ab\\N\u0006\n é'\"")), max_size=12))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELD, FIELD), min_size=1, max_size=8))
def test_delimited_round_trip_property(spark, tmp_path_factory, rows):
    data = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, a string, b string").coalesce(1)
    out = os.path.join(str(tmp_path_factory.mktemp("rt")), "o")
    DL.export_delimited(df, out, out + "-q")
    back = sorted(tuple(r) for r in DL.import_delimited(spark, out, df.schema)[0].collect())
    assert back == sorted(data)


def _classify_py(sql, err):
    f = {"sql": (sql or "").lower(), "err": (err or "").lower()}
    for cat, groups in RU.ERROR_RULES:
        if all(any(n in f[field] for n in needles) for field, needles in groups):
            return cat
    return RU.DEFAULT_CATEGORY


NEEDLES = [n for _, g in RU.ERROR_RULES for _, ns in g for n in ns]
TEXT = st.lists(st.sampled_from(NEEDLES + ["select", "x", "TABLE", "Full Join"] + list(string.ascii_letters[:3])),
                max_size=4).map(" ".join)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=10))
def test_classify_matches_rule_list(spark, pairs):
    df = spark.createDataFrame(pairs, "sql string, err string")
    got = [r[0] for r in df.select(L.classify_error("sql", "err")).collect()]
    assert got == [_classify_py(s, e) for s, e in pairs]


def test_exact_sums_equal_decimal_sums(spark):
    from wareshift.operators.aggregates import exact_sums

    rows = [(i % 3, (i * 7919 % 100003) / 100.0 if i % 11 else None, 1.005 + i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, x double, y double").repartition(7)
    got = {r.k: (r.x, r.y) for r in exact_sums(df, ["k"], {"x": F.col("x"), "y": F.col("y")}).collect()}
    want = {r.k: (r.x, r.y) for r in df.groupBy("k").agg(F.sum(F.col("x").cast("decimal(15,2)")).alias("x"),
                                                          F.sum(F.col("y").cast("decimal(15,2)")).alias("y")).collect()}
    assert got == want


def test_sequence_under_hot_sort_key(spark):
    df, pdf = _skewed(spark)
    out = D.with_sequence(df, "seq", 1, order_by=["k"])
    got = out.select("k", "seq").collect()
    assert sorted(r.seq for r in got) == list(range(1, len(pdf) + 1))
    by_seq = [r.k for r in sorted(got, key=lambda r: r.seq)]
    assert by_seq == sorted(pdf.k)
    # the range sort also cuts on the row hash: the hot key (2/3 of the rows)
    # is spread over several range partitions instead of one task
    # (AQE would coalesce this tiny shuffle into one partition, so it is off here)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        sizes = (df.sort("k", D.row_hash(df)).groupBy(F.spark_partition_id().alias("p"))
                 .count().collect())
        plain = (df.sort("k").groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set(key, before)
    assert max(r["count"] for r in plain) >= 4000  # without the hash: the hot key is one task
    assert max(r["count"] for r in sizes) < len(pdf) / 2


def test_key_changes_with_hot_target_key(spark):
    # key 0 holds 2/3 of the target; the source repeats it too (de-duplicated
    # by version), so the left/anti joins meet a hot key on the target side
    df, pdf = _skewed(spark)
    src_rows = [(0, 7, 1), (0, 8, 2), (3, 9, 1), (424242, 1, 1)]
    src = spark.createDataFrame(src_rows, "k long, d long, version long")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        upd_df = D.update_from(df, src, ["k"], ["d"], order_by=["version"])
        upd = sorted(tuple(r) for r in upd_df.select("k", "d", "v").collect())
        saved_df = D.mark_saved(df, src, "k")
        saved = {r.v: r.saved for r in saved_df.collect()}
        # the de-duplicated source comes out of an aggregate, yet AQE still
        # splits the hot target partition (both join sides are shuffled)
        for out in (upd_df, saved_df):
            out.collect()
            assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
        kept = sorted(r.v for r in D.delete_keys(df, src, ["k"]).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    latest = {0: 8, 3: 9, 424242: 1}
    want = sorted((k, latest.get(k, d), v) for k, d, v in pdf.itertuples(index=False))
    assert upd == want
    assert saved == {v: k in latest for k, _, v in pdf.itertuples(index=False)}
    assert kept == sorted(v for k, _, v in pdf.itertuples(index=False) if k not in latest)


def test_ancestor_join_hot_root_with_aggregated_parents(spark):
    # every child shares the root prefix 'r', and one path holds four fifths
    # of the children; the parent side is the output of an aggregate
    # (distinct), which would otherwise keep AQE from splitting the hot path
    # (large and varied enough that the hot partition stays big after shuffle compression)
    rows = [("r|a|7" if i % 5 else "r|b|%d" % i, (i * 7919) % 1000003) for i in range(60000)]
    kids = spark.createDataFrame(rows, "path string, v long").repartition(8)
    parents = spark.createDataFrame([("r",), ("r|a",), ("r|b",), ("r",), ("q",)], "p string").distinct()
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = J.ancestor_join(kids, parents, "path", "p", mode="path")
        got = sorted((r.p, r.v) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = sorted((p, v) for path, v in rows for p in ("r", "r|a", "r|b") if path == p or path.startswith(p + "|"))
    assert got == want
    assert "SortMergeJoin(skew=true)" in plan
    # below the expansion into prefixes there are distinct paths only
    assert "Generate" in plan
    for below in plan.split("Generate")[1:]:
        assert "HashAggregate(keys=[__path" in below.split("\n")[1] + below.split("\n")[2] + below.split("\n")[3]


KEY = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(KEY, KEY), max_size=12), st.lists(st.tuples(KEY, KEY), max_size=8),
       st.sampled_from(["left", "inner", "left_anti", "left_semi"]), st.sampled_from([1, 2]))
def test_lookup_join_equals_plain_equi_join(spark, left, right, how, nkeys):
    # struct equality (with null lookup keys dropped) must give exactly the
    # rows of the plain equality join, nulls included
    a = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(left)], "id int, a1 int, a2 int")
    b = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(right)], "jd int, b1 int, b2 int")
    lk, rk = ["a1", "a2"][:nkeys], ["b1", "b2"][:nkeys]
    split = J.lookup_join(a, b, lk, rk, how, split_hot_keys=True)
    plain = J.lookup_join(a, b, lk, rk, how, split_hot_keys=False)
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


IV = st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-5, 60)), st.one_of(st.none(), st.integers(-5, 60)))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-5, 60))), max_size=25),
       st.lists(IV, max_size=10), st.sampled_from([1, 3, 7, 100]),
       st.sampled_from(["inner", "left", "left_semi", "left_anti"]))
def test_bucketed_range_join_property(spark, facts, dims, width, how):
    f = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(facts)], "k int, v int, id int")
    d = spark.createDataFrame([(k, lo, hi, j) for j, (k, lo, hi) in enumerate(dims)], "k int, lo int, hi int, d int")
    plain = J.range_join(f, d, ["k"], "v", "lo", "hi", how)
    bucketed = J.range_join(f, d, ["k"], "v", "lo", "hi", how, bucket=width)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, bucketed.collect()), key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.text("ab|", max_size=9))), max_size=12),
       st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.text("ab|", max_size=5))), max_size=8))
def test_containment_property(spark, kids, parents):
    # short, empty, repeated and null paths on both sides
    c = spark.createDataFrame([(k, p, i) for i, (k, p) in enumerate(kids)], "k int, c string, ci int")
    p = spark.createDataFrame([(k, q, j) for j, (k, q) in enumerate(parents)], "k int, p string, pj int")
    want = sorted((i, j) for i, (kc, cp) in enumerate(kids) for j, (kp, pp) in enumerate(parents)
                  if kc == kp and cp is not None and pp is not None and pp in cp)
    assert sorted((r.ci, r.pj) for r in J.containment_join(c, p, "c", "p", keys=["k"]).collect()) == want
    counts = {r.pj: r.children for r in J.containment_count(c, p, "c", "p", keys=["k"]).collect()}
    assert counts == {j: sum(b == j for _, b in want) for j in {b for _, b in want}}
    assert sorted(r.pj for r in J.contained_in_any(p, c, "p", "c", keys=["k"]).collect()) == sorted({j for _, j in want})


def test_containment_costs_a_row_per_gram_not_per_substring(spark):
    c = spark.createDataFrame([("x" * 50 + "%04d" % i + "y" * 50,) for i in range(40)], "c string")
    p = spark.createDataFrame([("x" * n,) for n in range(1, 41)] + [("0007y",), ("q",)], "p string")
    got = J.contained_pairs(c, p, "c", "p")
    assert got.count() == 40 * 40 + 1
    got.collect()
    made = _rows_made(got, "Generate")
    # distinct grams of 1, 2 and 3 characters of 104, not the 40 lengths' substrings
    assert max(made) <= 40 * 3 * 20


def _rows_made(df, node):
    """Output rows of every ``node`` of the executed plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(plan.executedPlan())
        elif hasattr(plan, "plan") and name.endswith("QueryStage"):
            todo.append(plan.plan())
        kids = plan.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        metrics = plan.metrics()
        if name == node and metrics.contains("numOutputRows"):
            found.append(metrics.apply("numOutputRows").value())
    return found


IVL = st.tuples(st.integers(0, 1), st.integers(-(10**6), 10**6), st.one_of(st.integers(0, 40), st.integers(0, 2 * 10**6)))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-(10**6), 10**6)), max_size=25), st.lists(IVL, max_size=10),
       st.sampled_from([1, 10, 1000]), st.sampled_from(["inner", "left", "left_semi", "left_anti"]))
def test_range_join_of_any_length_property(spark, facts, dims, width, how):
    f = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(facts)], "k int, v long, id int")
    d = spark.createDataFrame([(k, lo, lo + n, j) for j, (k, lo, n) in enumerate(dims)], "k int, lo long, hi long, d int")
    plain = J.range_join(f, d, ["k"], "v", "lo", "hi", how)
    covered = J.range_join(f, d, ["k"], "v", "lo", "hi", how, bucket=width)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, covered.collect()), key=repr)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-70, 70), st.integers(-3, 150)), min_size=1, max_size=20))
def test_dyadic_cover_is_exact_and_disjoint(spark, spans):
    df = spark.createDataFrame([(a, a + n) for a, n in spans], "a long, b long")
    for r in df.select("a", "b", J.dyadic_cover("a", "b").alias("c")).collect():
        numbers = [x for b in r.c for x in range(b.node << b.level, (b.node + 1) << b.level)]
        assert sorted(numbers) == list(range(r.a, r.b + 1))
        assert len({b.level for b in r.c}) * 2 >= len(r.c)


def test_an_open_interval_costs_few_rows(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(1992, 1, 1) + dt.timedelta(days=i), dt.date(9999, 12, 31)) for i in range(400)],
                               "lo date, hi date")
    days = df.select(J._bucket_of(F.col("lo"), 1, "date").alias("a"), J._bucket_of(F.col("hi"), 1, "date").alias("b"))
    assert days.select(F.max(F.size(J.dyadic_cover("a", "b"))).alias("n")).first().n < 50
    facts = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(1992, 1, 5),), (dt.date(1991, 1, 1),)], "day date")
    j = J.range_join(facts, df, [], "day", "lo", "hi", bucket=1)
    assert {r["day"].year: r["count"] for r in j.groupBy("day").count().collect()} == {2024: 400, 1992: 5}
    infinite = spark.createDataFrame([(0.5, float("inf")), (float("-inf"), 2.0)], "lo double, hi double")
    points = spark.createDataFrame([(1.0,), (1e300,), (-1e300,)], "x double")
    got = J.range_join(points, infinite, [], "x", "lo", "hi", bucket=0.25)
    assert sorted((r.x, r.lo) for r in got.collect()) == [(-1e300, float("-inf")), (1.0, float("-inf")), (1.0, 0.5), (1e300, 0.5)]


def test_deep_pages_are_cut_from_ranges(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(30000)], "k long, v long").repartition(8)
    whole = sorted((i % 7, i) for i in range(30000))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rest = W.page(df, ["k", "v"], offset=12345)
        plan = rest._jdf.queryExecution().executedPlan().toString()
        assert "Limit" not in plan and "Offset" not in plan and rest.rdd.getNumPartitions() > 4
        assert [tuple(r) for r in rest.collect()] == whole[12345:]
        assert [tuple(r) for r in W.page(df, ["k", "v"], limit=100, offset=20000).collect()] == whole[20000:20100]
    finally:
        spark.conf.set(key, before)
    assert [tuple(r) for r in W.page(df, ["k", "v"], limit=100, offset=50).collect()] == whole[50:150]
    assert W.page(df, ["k", "v"], offset=30000).count() == 0
    assert W.page(df, ["k", "v"], offset=0).count() == 30000
