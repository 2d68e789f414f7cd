from pyspark.sql import functions as F

from wareshift.functions import rules as RU
from wareshift.operators import querylog as L


def test_classify_each_rule_and_first_wins(spark):
    rows = [
        ("select 1", "Duplicate entry '1' for key x; insert into t", "ignore_duplicate_insert"),
        ("select 1", "only_full_group_by", "modify_group_by"),
        ("select 1", "Incorrect datetime value: 'x'", "modify_date_format"),
        ("select * from a FULL OUTER JOIN b", "boom", "modify_full_join"),
        ("select 1", "Column 'a' cannot be null", "modify_wrong_sql"),
        ("select 1", "Invalid transaction", "delay"),
        ("select instr(a, 'b')", "boom", "modify_func_not_support"),
        ("/*& background:true */ insert", "boom", "ignore_etl"),
        ("/*& requestId:1 */ select 1", "boom", "ignore_tableau"),
        ("select 1", "Table 'a.b' doesn't exist", "ignore_schema_mismatch"),
        ("select 1", "sql文本长度超过最大解析长度", "modify_sql_too_big"),
        ("select 1", "something else", "not_processed"),
        # meets two rules: full join (rule 4) before cannot be null (rule 5)
        ("select * from a full join b", "Column 'a' cannot be null", "modify_full_join"),
    ]
    df = spark.createDataFrame(rows, "sql string, err string, want string")
    got = df.select("want", L.classify_error("sql", "err").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert len(rows) - 2 == len(RU.ERROR_RULES)


def test_tenant_resolution(spark):
    rows = [("q1", "acme_internal_read", "global_x", "select * from {{tenant}}.t"),
            ("q2", "other", "acme_custom", "select * from {{tenant}}.t"),
            ("q3", "other", "global_x", "select * from {{tenant}}.t"),
            ("q4", "other", "global_x", "select 1")]
    df = spark.createDataFrame(rows, "id string, user string, db string, statement string")
    got = {r.id: r.statement for r in L.resolve_tenant(df).collect()}
    assert got == {"q1": "select * from acme.t", "q2": "select * from acme.t", "q4": "select 1"}


def test_rewrite_order_and_hints(spark):
    df = spark.createDataFrame([("select isnull(a) -- c NULLS FIRST nullvalue(b) cast (x as string) from global_dw.t", True),
                                ("select CAST(a AS STRING)", False)], "s string, enabled boolean")
    got = [r[0] for r in df.select(L.rewrite_text("s", "enabled")).collect()]
    assert got[0] == "select ifnull(a) --  c  isnull(b) concat(x) from global_dw_1.t"
    assert got[1] == "select CAST(a AS STRING)"
    h = spark.createDataFrame([("a /*& x */ b /*& y */ c\nd /*& z */",)], "s string")
    assert h.select(L.strip_hints("s")).first()[0] == "a  c\nd "


def test_claim_filters_before_limit(spark):
    rows = [(i, "q%d" % i, "" if i <= 3 else "select %d" % i, "db", None) for i in range(1, 8)]
    st = spark.createDataFrame(rows, "order_id long, query_id string, tidb_sql string, db string, execute_result int")
    got = [r.order_id for r in L.claim_batch(st, 0, 2).collect()]
    assert got == [4, 5]


def test_claims_take_the_rest_of_a_tie(spark):
    rows = [(o, q, "select 1", "db", None) for o, q in [(1, "a"), (2, "c"), (2, "b"), (2, "d"), (3, "e")]]
    st = spark.createDataFrame(rows, "order_id long, query_id string, tidb_sql string, db string, execute_result int")
    got, last = [], (0, None)
    while some := L.claim_batch(st, last[0], 2, last_query_id=last[1]).collect():
        got += [r.query_id for r in some]
        last = (some[-1].order_id, some[-1].query_id)
    assert got == ["a", "b", "c", "d", "e"]


def test_outcome_and_progress(spark):
    import datetime as dt

    st = spark.createDataFrame([("a", None, None, None), ("b", None, None, None)],
                               "query_id string, execute_result int, tidb_duration double, execute_time timestamp_ntz")
    res = spark.createDataFrame([
        ("a", "select 1", "", 1.0, dt.datetime(2024, 1, 1), False),
        ("b", "select 1", "Query execution was interrupted", 20.0, dt.datetime(2024, 1, 1, 0, 0, 10), True)],
        "query_id string, sql string, err_msg string, duration double, executed_at timestamp_ntz, timed_out boolean")
    out = {r.query_id: (r.execute_result, r.tidb_duration) for r in L.record_outcome(st, res).collect()}
    assert out == {"a": (1, 1.0), "b": (0, 20.0)}
    cats = {r.query_id: r.catalog for r in L.outcome_rows(res).collect()}
    assert cats == {"a": None, "b": "timeout"}
    p = L.progress(L.record_outcome(st, res)).first()
    assert (p.finished, p.failed) == (2, 1) and abs(p.rate - 0.2) < 1e-9


def test_noise_and_known_errors(spark):
    df = spark.createDataFrame([("select NDV(a)", "d"), ("select 1", "skip_db"), ("select 2", "d")], "statement string, db string")
    assert [r.statement for r in L.drop_noise(df, drop_dbs=["skip_db"]).collect()] == ["select 2"]
    e = spark.createDataFrame([("不支持转换的函数 regexp_replace",), ("不支持转换的函数 foo",)], "e string")
    assert [r[0] for r in e.select(L.is_known_translate_error("e")).collect()] == [True, False]
    assert F is not None


def test_apply_retry_outcomes(spark):
    import datetime as dt

    st = spark.createDataFrame([("a", "old", 0, None, None), ("b", "old", 0, None, None), ("c", "old", 0, None, None),
                                ("z", "keep", 1, 2.0, None)],
                               "query_id string, tidb_sql string, execute_result int, tidb_duration double, execute_time timestamp_ntz")
    er = spark.createDataFrame([("a", "d", "h", "e1", "delay"), ("b", "d", "h", "e2", "delay"), ("c", "d", "h", "e3", "delay")],
                               "query_id string, sql_date string, hash_id string, err_msg string, catalog string")
    t = dt.datetime(2024, 1, 1)
    at = spark.createDataFrame([("a", True, "select 1", "", 1.5, t, False),
                                ("b", True, "select * from x full join y", "Column 'c' cannot be null", 2.0, t, False),
                                ("c", False, None, "translate failed", None, None, False)],
                               "query_id string, translated boolean, new_sql string, err_msg string, duration double, executed_at timestamp_ntz, timed_out boolean")
    s2, e2 = L.apply_retry(st, er, at)
    s = {r.query_id: (r.tidb_sql, r.execute_result, r.tidb_duration) for r in s2.collect()}
    assert s == {"a": ("select 1", 1, 1.5), "b": ("select * from x full join y", 0, None), "c": ("", None, None),
                 "z": ("keep", 1, 2.0)}
    e = {r.query_id: (r.err_msg, r.catalog) for r in e2.collect()}
    assert e == {"b": ("Column 'c' cannot be null", "modify_full_join"), "c": ("translate failed", "translate_error")}


def test_operators_on_whole_long_statements(spark):
    # logged statements run to millions of characters; every regex-based
    # step must process them whole (no per-character recursion)
    big = "select cast(a as string), isnull(b, 1) /*& hint */ -- c\n" * 20000 + "from t where x = '{{tenant}}'"
    df = spark.createDataFrame([(big, "u1_internal_read", "db1", "boom")], "statement string, user string, db string, err string")
    r = df.select(L.rewrite_text("statement").alias("rw"), L.strip_hints("statement").alias("sh"),
                  L.classify_error("statement", "err").alias("cat")).first()
    assert "cast(a as string)" not in r.rw and r.rw.count("concat(a)") == 20000
    assert "/*&" not in r.sh and len(r.sh) == len(big) - 20000 * len("/*& hint */")
    assert r.cat == "not_processed"
    t = L.resolve_tenant(df).first().statement
    assert t.endswith("'u1'") and len(t) == len(big) - len("{{tenant}}") + 2
