import json
import os

from pyspark.sql import functions as F

from wareshift.operators import changes as D
from wareshift.operators import filters as P
from wareshift.operators import schema as SC
from wareshift.sources import logs


def test_read_log_records_defaults(spark, tmp):
    p = os.path.join(tmp, "tasks.json")
    recs = [
        {"queryId": "a", "tenant": "t", "db": "d", "hash": {"value": "h", "valid": True}, "sqlType": "Query",
         "duration": 1.0, "impalaSql": "select 1", "tidbSql": "select 1", "success": True, "error": None},
        {"queryId": "b", "tenant": "t", "db": "d", "hash": {"value": "h", "valid": False},
         "duration": 2.0, "impalaSql": "select 2", "tidbSql": "x", "success": False, "error": "e"},
        {"queryId": "c", "tenant": "t", "db": "d", "duration": 3.0, "impalaSql": "s", "tidbSql": "s",
         "success": True, "error": None},
    ]
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    with open(p, "a") as f:
        f.write('\n{"queryId": broken\n\n{"tenant": "no id"}\n')
    tasks, rejected = logs.read_log_records(spark, p)
    assert sorted(r.value for r in rejected.collect()) == ['{"queryId": broken', '{"tenant": "no id"}']
    got = {r.query_id: (r.hash_id, r.sql_type, r.tidb_sql) for r in tasks.collect()}
    assert got == {"a": ("h", "Query", "select 1"), "b": ("", "unknown", ""), "c": ("", "unknown", "s")}


def test_read_statements_split_and_replace(spark, tmp):
    p = os.path.join(tmp, "s.sql")
    with open(p, "w") as f:
        f.write("create table a_${d} (x int);\n\n;  insert into a_${d} values (1) ;\n")
    got = [r.stmt for r in logs.read_statements(spark, p, {"${d}": "0115"}).orderBy("pos").collect()]
    assert got == ["create table a_0115 (x int)", "insert into a_0115 values (1)"]


def test_analyze_table(spark, tmp):
    p = os.path.join(tmp, "t")
    spark.range(10).write.parquet(p)
    spark.sql(f"CREATE TABLE IF NOT EXISTS analyzed_t USING parquet LOCATION '{p}'")
    info = {r.col_name: r.data_type for r in D.analyze_table(spark, "analyzed_t").collect()}
    assert "10 rows" in info.get("Statistics", "")
    spark.sql("DROP TABLE analyzed_t")


def test_base_tables_soft_delete_and_schema_files(spark, tmp):
    cat = spark.createDataFrame([("d", "t1", "BASE TABLE"), ("d", "v1", "VIEW"), ("e", "t2", "BASE TABLE")],
                                "db string, tbl string, table_type string")
    assert [r.tbl for r in P.base_tables(cat, "d").collect()] == ["t1"]
    df = spark.createDataFrame([(1, "abc", False), (2, None, True), (3, "x", None)], "id long, name string, is_removed boolean")
    assert [r.id for r in P.not_removed(df).orderBy("id").collect()] == [1, 3]
    cols = SC.extract_schema(spark, df, "d", "t1", keys=["id"])
    counts = spark.createDataFrame([("d", "t1", 3)], "db string, tbl string, record_count long")
    out = os.path.join(tmp, "schemas")
    SC.write_schema_files(SC.schema_records(cols, counts), out)
    back = SC.read_schema_files(spark, out)
    rows = sorted((r.pos, r.name, r.type, r.len, r.is_key, r.record_count) for r in back.collect())
    assert rows == [(1, "id", "bigint", 0, True, 3), (2, "name", "string", 3, False, 3),
                    (3, "is_removed", "boolean", 0, False, 3)]
    assert [r.tbl for r in P.tables_in_schema_files(cat, back).collect()] == ["t1"]
    assert F is not None


def test_insert_values_both_modes(spark):
    from wareshift.sources import inserts

    df = spark.createDataFrame([(i, "it's %d" % i, None if i % 2 else 1.5) for i in range(2500)],
                               "id long, s string, x double").repartition(3)
    ordered = inserts.to_insert_values(df, "t", ["id"], 1000).orderBy("batch").collect()
    assert [r.batch for r in ordered] == [0, 1, 2]
    assert ordered[0].stmt.startswith("insert into t (id, s, x) values (0, 'it\\'s 0', 1.5),(1, 'it\\'s 1', NULL)")
    loose = inserts.to_insert_values(df, "t", None, 1000).collect()
    counts = [r.stmt.count("),(") + 1 for r in loose]
    assert sum(counts) == 2500 and max(counts) <= 1000


def test_insert_statements_are_bounded_in_bytes(spark):
    from wareshift.sources import inserts

    sizes = [10, 10, 900, 10, 400, 400, 400, 3000, 5, 5, *[90] * 40]
    df = spark.createDataFrame([(i, "é" * (n // 2)) for i, n in enumerate(sizes)], "id long, s string").repartition(2)
    for order_by in (["id"], None):
        got = inserts.to_insert_values(df, "t", order_by, 30, max_bytes=1000).orderBy("batch", "part").collect()
        rows = [r.stmt.split(" values ")[1].split("),(") for r in got]
        ids = [int(x.lstrip("(").split(",")[0]) for each in rows for x in each]
        assert sorted(ids) == list(range(len(sizes))) and (order_by is None or ids == sorted(ids))
        assert all(len(each) <= 30 for each in rows)
        assert all(len(each) == 1 or len(r.stmt.split(" values ")[1].encode()) <= 1000 + len(each) for r, each in zip(got, rows))


def test_unordered_insert_batches_do_not_depend_on_arrival_order(spark):
    # a shuffle output holds the same rows whatever order they arrive in; the
    # cheap mode must cut the same statements from either order (batch 5: the
    # partitions hold 12k rows, so plain positions would cut different batches)
    from wareshift.sources import inserts

    rows = [(i % 5, f"v{i}") for i in range(60)]
    a = spark.createDataFrame(rows, "k int, s string").repartition(3, "k")
    b = spark.createDataFrame(list(reversed(rows)), "k int, s string").repartition(3, "k")
    sa = sorted(r.stmt for r in inserts.to_insert_values(a, "t", None, 5).collect())
    sb = sorted(r.stmt for r in inserts.to_insert_values(b, "t", None, 5).collect())
    assert sa == sb and sum(s.count("(") - 1 for s in sa) == 60


def test_run_query_tool_writes_results(spark, tmp, small_dir, capsys):
    import sys as _sys

    _sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    import run_query

    assert run_query.main(["run_query", "--list"]) == 0
    assert "plan_vs_actual" in capsys.readouterr().out.split()
    assert run_query.main(["run_query", small_dir, tmp, "no_such_query"]) == 2
    assert run_query.main(["run_query", small_dir, tmp, "plan_vs_actual"]) == 0
    assert spark.read.parquet(os.path.join(tmp, "plan_vs_actual")).count() == 25
