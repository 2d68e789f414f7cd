import os

import pytest
from pyspark.sql import functions as F

from wareshift.sources import delimited as DL
from wareshift.sources import generations as G

SCHEMA = "id bigint, s string, flag boolean, x double"


def _rows():
    return [
        (1, "a\u0006b", True, 1.5),
        (2, "ends\\", False, None),
        (3, "\\N", None, 2.0),
        (4, None, True, 3.0),
        (5, "", False, 4.0),
        (6, "has\u0007eol", True, 5.0),
        (7, "multi\nline \\ mix \u0006\u0006", False, -1.0),
    ]


def test_round_trip_and_quarantine(spark, tmp):
    df = spark.createDataFrame(_rows(), SCHEMA)
    out, q = os.path.join(tmp, "out"), os.path.join(tmp, "q")
    assert tuple(DL.export_delimited(df, out, q)[:2]) == (6, 1)
    back, rejected = DL.import_delimited(spark, out, df.schema)
    assert rejected.count() == 0
    got = sorted(tuple(r) for r in back.collect())
    want = sorted(r for r in _rows() if r[0] != 6)
    assert got == want
    assert [r.id for r in spark.read.parquet(q).collect()] == [6]
    raw = b"".join(open(os.path.join(out, f), "rb").read() for f in os.listdir(out) if f.startswith("part-"))
    assert b'"' not in raw and b"\x07" in raw


def _parts(folder):
    """Bytes of each numbered part; a part is one file."""
    out = {}
    for name in os.listdir(folder):
        if name.startswith("file="):
            files = [f for f in os.listdir(os.path.join(folder, name)) if f.startswith("part-")]
            assert len(files) == 1
            out[name.removeprefix("file=")] = os.path.getsize(os.path.join(folder, name, files[0]))
    return out


def test_sized_parts_manifest_and_name_list(spark, tmp):
    df = spark.range(5000).select(F.col("id"), F.concat(F.lit("name-"), F.col("id").cast("string")).alias("s"))
    out = os.path.join(tmp, "parts")
    done = DL.write_sized_parts(df.repartition(2), out, os.path.join(tmp, "q"), max_bytes=4096, prefix="db.t")
    assert done.written == df.count() and done.quarantined == 0
    parts = _parts(done.folder)
    assert sorted(parts) == [f"db.t.{i:03d}" for i in range(1, done.parts + 1)]
    assert max(parts.values()) <= 4096 and done.parts <= sum(parts.values()) // (4096 - 30) + 2
    back, rejected = DL.import_delimited(spark, out, df.schema)
    assert rejected.count() == 0 and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    names = os.path.join(tmp, "names")
    DL.write_name_list(spark.createDataFrame([("b",), ("a",), ("b",)], "n string"), "n", names)
    text = "".join(open(os.path.join(names, f)).read() for f in sorted(os.listdir(names)) if f.startswith("part-"))
    assert text.split() == ["a", "b"]
    empty = os.path.join(tmp, "empty")
    DL.empty_like(df, empty)
    e = spark.read.parquet(empty)
    assert e.count() == 0 and e.columns == ["id", "s"]
    app = os.path.join(tmp, "app")
    DL.append_table(df.limit(3), app)
    DL.append_table(df.limit(2), app)
    assert spark.read.parquet(app).count() == 5


def test_export_tables_and_folder_manifest(spark, tmp):
    root = os.path.join(tmp, "export")
    a = spark.createDataFrame([(i, i % 2 == 0, "x%d" % i) for i in range(300)], "id int, flag boolean, s string")
    b = spark.createDataFrame([(1, "has\u0007eol"), (2, "ok")], "id int, s string")
    quarantine = os.path.join(tmp, "q")
    first = DL.export_table(a, root, "global_a", "t1", quarantine, max_bytes=1024)
    assert first[:2] == (300, 0) and set(_parts(first.folder)) == {f"global_a.t1.{i:03d}" for i in range(1, first.parts + 1)}
    old = DL.export_table(b, root, "global_a", "t2", quarantine)
    new = DL.export_table(b, root, "global_a", "t2", quarantine)  # takes the old content's place
    assert old[:2] == new[:2] == (1, 1) and old.folder != new.folder
    man = {r.table: (r.files, r.bytes) for r in DL.file_manifest(spark, root, "part-*", by="part").collect()}
    assert man == {"global_a.t1": (first.parts, sum(_parts(first.folder).values())), "global_a.t2": (1, 5)}
    back, _ = DL.import_delimited(spark, os.path.join(root, "global_a.t1"), spark.createDataFrame([], "id int, flag int, s string").schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted((i, int(i % 2 == 0), "x%d" % i) for i in range(300))
    assert [r.id for r in spark.read.parquet(os.path.join(tmp, "q", "global_a.t2")).collect()] == [1]
    plain = os.path.join(tmp, "plain")
    os.makedirs(plain)
    for name, text in (("d.t.001.csv", "abc"), ("d.t.002.csv", "de"), ("d.u.001.csv", "f")):
        with open(os.path.join(plain, name), "w") as f:
            f.write(text)
    assert {r.table: (r.files, r.bytes) for r in DL.file_manifest(spark, plain).collect()} == {"d.t": (2, 5), "d.u": (1, 1)}


def test_one_wide_line_among_short_rows(spark, tmp):
    # a line above half the limit is a part of its own; the others' parts stay full
    rows = [(i, f"name-{i}") for i in range(5000)] + [(90001, "w" * 3000), (90002, "v" * 9000), (90003, "u" * 1900)]
    df = spark.createDataFrame(rows, "id long, s string").repartition(2)
    done = DL.write_sized_parts(df, os.path.join(tmp, "wide"), os.path.join(tmp, "q"), max_bytes=4096)
    parts = sorted(_parts(done.folder).values())
    assert parts[-1] == 9007 and parts[-2] <= 4096 and len(parts) == done.parts
    assert done.parts <= sum(parts) // (4096 - 1907) + 4
    back = sorted(tuple(r) for r in DL.import_delimited(spark, os.path.join(tmp, "wide"), df.schema)[0].collect())
    assert back == sorted(rows)


@pytest.mark.parametrize("limit", [1, 7, 64, 1000])
def test_parts_keep_every_row_at_any_limit(spark, tmp, limit):
    rows = [(i, "é" * (i * 7919 % 83)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, s string").repartition(5)
    done = DL.write_sized_parts(df, os.path.join(tmp, "o"), os.path.join(tmp, "q"), max_bytes=limit)
    parts = _parts(done.folder)
    widest = max(len(f"{i}\x06{s}\x07".encode()) for i, s in rows)
    assert len(parts) == done.parts and all(n <= max(limit, widest) for n in parts.values())
    assert sorted(int(name.split(".")[1]) for name in parts) == list(range(1, done.parts + 1))
    assert sorted(map(tuple, DL.import_delimited(spark, os.path.join(tmp, "o"), df.schema)[0].collect())) == sorted(rows)


def test_a_failed_export_keeps_the_old_table(spark, tmp):
    out = os.path.join(tmp, "t")
    df = spark.createDataFrame([(1, "old")], "id int, s string")
    DL.write_sized_parts(df, out, os.path.join(tmp, "q"))
    broken = spark.range(10).select(F.col("id").cast("int"), F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise("new").alias("s"))
    with pytest.raises(Exception, match="lost"):
        G.replace(spark, out, lambda folder: broken.write.mode("overwrite").parquet(folder))
    assert [tuple(r) for r in DL.import_delimited(spark, out, df.schema)[0].collect()] == [(1, "old")]
    DL.write_sized_parts(df.withColumn("s", F.lit("new")), out, os.path.join(tmp, "q"))
    assert [tuple(r) for r in DL.import_delimited(spark, out, df.schema)[0].collect()] == [(1, "new")]
    none = DL.write_sized_parts(df.limit(0), out, os.path.join(tmp, "q"))
    assert none.written == none.parts == 0 and DL.import_delimited(spark, out, df.schema)[0].count() == 0


def test_empty_lines_are_rejected_not_lost(spark, tmp):
    sep = DL.FIELD_SEP
    path = os.path.join(tmp, "in")
    spark.createDataFrame([(f"1{sep}a",), ("",), (f"2{sep}b",)], "value string").coalesce(1).write.option("lineSep", DL.ROW_SEP).text(path)
    good, rejected = DL.import_delimited(spark, path, spark.createDataFrame([], "id int, s string").schema)
    assert good.count() == 2 and [tuple(r) for r in rejected.collect()] == [("", "1 fields, not 2, id is not int")]


def test_round_trip_long_fields_and_empty_first_field(spark, tmp):
    # fields of hundreds of thousands of characters full of escapes (the
    # tokenizer must not recurse per character), an empty first field, and
    # a one-column table whose values include the empty string
    long_a = ("x\\y\u0006z" * 60000) + "\\"
    long_b = "a" * 500000
    rows = [("", long_a, 1), (None, long_b, 2), ("", "", 3), ("\\N", None, 4)]
    df = spark.createDataFrame(rows, "a string, b string, k int")
    out = os.path.join(tmp, "long")
    DL.export_delimited(df, out, os.path.join(tmp, "q"))
    back = sorted(DL.import_delimited(spark, out, df.schema)[0].collect(), key=lambda r: r.k)
    assert [tuple(r) for r in back] == rows
    one = spark.createDataFrame([("",), ("v",), (None,)], "s string")
    out1 = os.path.join(tmp, "one")
    DL.export_delimited(one, out1, os.path.join(tmp, "q1"))
    assert sorted(DL.import_delimited(spark, out1, one.schema)[0].collect(), key=repr) == sorted(one.collect(), key=repr)


def test_lines_that_do_not_fit_are_rejected_with_reasons(spark, tmp):
    sep = DL.FIELD_SEP
    lines = [f"1{sep}a{sep}1", f"2{sep}b", f"3{sep}c{sep}0{sep}more", f"x{sep}d{sep}1", f"5{sep}e{sep}1\\", f"\\N{sep}\\N{sep}\\N"]
    path = os.path.join(tmp, "in")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("lineSep", DL.ROW_SEP).text(path)
    good, rejected = DL.import_delimited(spark, path, spark.createDataFrame([], "id int, s string, flag boolean").schema)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "a", True), (None, None, None)], key=str)
    reasons = {r.value: r.reason for r in rejected.collect()}
    assert reasons[lines[1]] == "2 fields, not 3" and reasons[lines[2]] == "4 fields, not 3"
    assert reasons[lines[3]] == "id is not int" and reasons[lines[4]] == "stray escape"
    assert len(reasons) == 4
