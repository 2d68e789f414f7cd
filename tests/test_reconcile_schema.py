import datetime as dt

from wareshift.operators import reconcile as R
from wareshift.operators import schema as SC


def test_catalog_diffs(spark):
    a = spark.createDataFrame([("d1", "t1", "c1"), ("d1", "t1", "c2"), ("d1", "t2", "c1"), ("d2", "t9", "c1")],
                              "db string, tbl string, col string")
    b = spark.createDataFrame([("d1", "t1", "c1"), ("d1", "t1", "c3"), ("d3", "t1", "c1")],
                              "db string, tbl string, col string")
    dbs = {r.db: r.side for r in R.diff_databases(a.select("db").distinct(), b.select("db").distinct()).collect()}
    assert dbs == {"d1": "both", "d2": "source_only", "d3": "target_only"}
    t = R.diff_tables(a.select("db", "tbl").distinct(), b.select("db", "tbl").distinct()).collect()
    assert [(r.db, r.source_only, r.target_only, r.common, r.missing_in_target) for r in t] == [("d1", 1, 0, 1, "t2")]
    c = R.diff_columns(a, b).collect()
    # both directions are reported (the original compared a set with itself)
    assert [(r.tbl, r.source_only, r.target_only, r.schema_match) for r in c] == [("t1", "c2", "c3", False)]
    rep = [r.table_name for r in R.mismatch_report(a.select("db", "tbl").distinct(), b.select("db", "tbl").distinct(),
                                                   R.diff_columns(a, b)).collect()]
    assert rep == ["d1.t1", "d1.t2", "d2.t9"]
    assert R.reload_plan(R.mismatch_report(a, b), a).count() == 2


def test_counts_and_maxima(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 1, 600000)
    src = spark.createDataFrame([("t1", 1, 1, ts), ("t1", 2, None, ts), ("t2", 1, None, None), ("t3", 5, 1, None)],
                                "tbl string, id long, version long, updated_at timestamp_ntz")
    tgt = spark.createDataFrame([("t1", 1, 1, dt.datetime(2024, 1, 1, 0, 0, 2)), ("t1", 2, None, None),
                                 ("t2", 1, None, None), ("t3", 5, 2, None), ("t3", 4, 2, None)],
                                "tbl string, id long, version long, updated_at timestamp_ntz")
    out = {r.tbl: (r.count_match, r.data_match) for r in R.compare_counts_max(src, tgt).collect()}
    # t1: seconds rounded on the source side match; t2: null maxima on both sides are equal
    assert out == {"t1": (True, True), "t2": (True, True), "t3": (False, False)}


def test_lengths_types_ddl(spark):
    df = spark.createDataFrame([(1, "abc", "é", None, "x")], "id long, name string, remark string, note string, tenant string")
    prof = {r.name: r.len for r in SC.profile_string_lengths(df, "t").collect()}
    assert prof == {"name": 3, "note": 0, "tenant": 1, "remark": 2000}
    pq = {r.name: r.len for r in SC.profile_string_lengths(df, "t", kind="parquet").collect()}
    assert pq["tenant"] == 50
    cols = SC.extract_schema(spark, df, "db", "t", keys=["id"], defaults={"name": "n"})
    ddl = SC.render_ddl(cols).first().ddl
    expected_lines = [
        "create table `db`.`t`", "(",
        "\t" + "`id`".ljust(25) + "bigint".ljust(40) + "not null".ljust(15) + "".ljust(20) + ",",
        "\t" + "`name`".ljust(25) + "varchar(50) character set utf8mb4".ljust(40) + "null".ljust(15) + 'default "n"'.ljust(20) + ",",
    ]
    assert ddl.split("\n")[:4] == expected_lines
    assert ddl.split("\n")[-2] == "\tPRIMARY KEY (`id`) /*T![clustered_index] CLUSTERED */"
    par = SC.extract_schema(spark, df, "db", "t", kind="parquet")
    assert par.orderBy("pos").first().name == "tenant"
    nopk = SC.render_ddl(par).first().ddl.split("\n")
    assert not nopk[-2].endswith(",") and nopk[-1] == ")"


def test_minimal_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "a")], "tenant long, id long, x string")
    r = SC.minimal_key(df, "t", ["tenant", "id", "x"]).first()
    assert (r.candidate, r.candidate_unique, r.chosen) == ("tenant,id", False, "tenant,id,x")
    r = SC.minimal_key(df.filter("x = 'a'"), "t", ["tenant", "id", "x"]).first()
    assert (r.candidate_unique, r.chosen) == (True, "tenant,id")
