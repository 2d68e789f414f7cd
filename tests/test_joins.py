from pyspark.sql import functions as F

from wareshift.operators import joins as J


def _tree(spark):
    nodes = spark.createDataFrame([("1",), ("1|2",), ("1|2|3",), ("10",), ("10|4",)], "p_path string")
    kids = spark.createDataFrame([("1|2|3", 5), ("10|4", 7), ("1", 1)], "c_path string, v int")
    return nodes, kids


def test_ancestor_join_string_vs_path(spark):
    nodes, kids = _tree(spark)
    s = {(r.c_path, r.p_path) for r in J.ancestor_join(kids, nodes, "c_path", "p_path", mode="string").collect()}
    p = {(r.c_path, r.p_path) for r in J.ancestor_join(kids, nodes, "c_path", "p_path", mode="path").collect()}
    # '1' is a textual prefix of '10|4' but not a path ancestor
    assert ("10|4", "1") in s and ("10|4", "1") not in p
    brute = {(c, a) for c, _ in [("1|2|3", 0), ("10|4", 0), ("1", 0)]
             for a in ["1", "1|2", "1|2|3", "10", "10|4"] if c[:len(a)] == a}
    assert s == brute


def test_ancestor_rollup_pre_aggregates(spark):
    nodes, kids = _tree(spark)
    out = {r.p_path: r.v for r in J.ancestor_rollup(kids, "c_path", {"v": F.sum("v")}, nodes, "p_path",
                                                    mode="path").collect()}
    assert out == {"1": 6, "1|2": 5, "1|2|3": 5, "10": 7, "10|4": 7}


def test_containment_join_matches_brute_force(spark):
    parents = spark.createDataFrame([(1, "2|3"), (1, "1"), (1, "12"), (2, "3")], "k int, p string")
    kids = spark.createDataFrame([(1, "1|2|3"), (1, "11|12"), (2, "3|3")], "k int, c string")
    got = sorted((r.c, r.p) for r in J.containment_join(kids, parents, "c", "p", keys=["k"]).collect())
    brute = sorted((c, p) for kc, c in [(1, "1|2|3"), (1, "11|12"), (2, "3|3")]
                   for kp, p in [(1, "2|3"), (1, "1"), (1, "12"), (2, "3")] if kc == kp and p in c)
    assert got == brute


def test_not_in_is_null_aware(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    sub = spark.createDataFrame([(2,)], "s int")
    assert sorted(r.k for r in J.anti_not_in(df, sub, "k", "s").collect()) == [1]
    assert J.anti_not_in(df, sub.limit(0), "k", "s").count() == 3  # an empty list: nulls qualify too
    sub_null = spark.createDataFrame([(2,), (None,)], "s int")
    assert J.anti_not_in(df, sub_null, "k", "s").count() == 0


def test_units(spark):
    facts = spark.createDataFrame([("a", 10.0), ("b", 10.0), ("c", 10.0)], "t string, q double")
    f = spark.createDataFrame([("a", 2), ("a", 2), ("b", 0)], "t string, f int")
    got = {r.t: r.converted for r in J.convert_units(facts, f, "t", "f", "q").collect()}
    assert got == {"a": 5.0, "b": 10.0, "c": 10.0}


def test_bucketed_range_join_equals_plain_on_a_hot_key(spark):
    # one key holds all facts and 400 intervals: the plain form compares
    # every fact with every interval of the key, the bucketed form only with
    # the intervals touching its bucket -- same rows either way
    import datetime as dt

    facts = spark.createDataFrame([(0, (i * 37) % 8000, i) for i in range(8000)] + [(1, 5, -1), (2, None, -2)],
                                  "k int, v int, id int")
    dims = spark.createDataFrame([(0, 20 * j, 20 * j + 19 + (j % 3) * 15, j) for j in range(400)]
                                 + [(1, 10, 3, -9), (1, None, 9, -8)], "k int, lo int, hi int, d int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = J.range_join(facts, dims, ["k"], "v", "lo", "hi", how)
        bucketed = J.range_join(facts, dims, ["k"], "v", "lo", "hi", how, bucket=20)
        assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, bucketed.collect()), key=repr), how
    # dates: buckets of 7 days
    base = dt.date(1998, 1, 1)
    fd = spark.createDataFrame([(0, base + dt.timedelta(days=i % 90), i) for i in range(900)], "k int, v date, id int")
    dd = spark.createDataFrame([(0, base + dt.timedelta(days=10 * j), base + dt.timedelta(days=10 * j + 12), j)
                                for j in range(9)], "k int, lo date, hi date, d int")
    plain = J.range_join(fd, dd, ["k"], "v", "lo", "hi")
    bucketed = J.range_join(fd, dd, ["k"], "v", "lo", "hi", bucket=7)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, bucketed.collect()))
    assert "__fb" in bucketed._jdf.queryExecution().executedPlan().toString()


def test_bucketed_range_join_on_ntz_timestamps(spark):
    import datetime as dt

    base = dt.datetime(1998, 1, 1, 6, 30)
    facts = spark.createDataFrame([(i % 3, base + dt.timedelta(hours=7 * i), i) for i in range(400)],
                                  "k int, v timestamp_ntz, id int")
    dims = spark.createDataFrame([(j % 3, base + dt.timedelta(days=4 * j, hours=3), base + dt.timedelta(days=4 * j + 5), j)
                                  for j in range(30)], "k int, lo timestamp_ntz, hi timestamp_ntz, d int")
    for how in ("inner", "left"):
        plain = J.range_join(facts, dims, ["k"], "v", "lo", "hi", how)
        bucketed = J.range_join(facts, dims, ["k"], "v", "lo", "hi", how, bucket=2)
        assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, bucketed.collect()), key=repr)
