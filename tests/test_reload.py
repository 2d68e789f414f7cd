"""Compare, re-export the listed tables, load them, compare clean."""

import os

import pytest
from pyspark.sql import functions as F

from wareshift.operators import reconcile as R
from wareshift.sources import generations as G
from wareshift.sources import reload as RL

COLUMNS = ["id", "version", "name", "flag"]


class Warehouse:
    def __init__(self, spark, tmp):
        self.spark, self.tmp = spark, tmp
        self.reads = []
        self.source = {("a", "t1"): self.rows(300), ("a", "t2"): self.rows(50), ("b", "t1"): self.rows(20), ("b", "t3"): self.rows(7)}
        self.names = spark.createDataFrame(list(self.source), "db string, tbl string")
        self.columns = self.names.crossJoin(spark.createDataFrame(list(enumerate(COLUMNS)), "pos int, name string"))

    def rows(self, n):
        return self.spark.createDataFrame([(i, i % 4, f"n\\{i}\x06", i % 2 == 0) for i in range(n)],
                                          "id bigint, version bigint, name string, flag boolean")

    def read(self, db, tbl):
        self.reads.append(f"{db}.{tbl}")
        return self.source[db, tbl]

    def at(self, name):
        return os.path.join(self.tmp, name)

    def put(self, db, tbl, df):
        G.replace(self.spark, RL.target_path(self.at("target"), db, tbl), lambda p: df.write.mode("overwrite").parquet(p))

    def report(self):
        there = {k: df for k in self.source if (df := RL.read_target(self.spark, self.at("target"), *k)) is not None}
        tag = lambda frames: [df.select(F.lit(k[0]).alias("db"), F.lit(k[1]).alias("tbl"), "id", "version") for k, df in frames.items()]
        src, dst = tag(self.source), tag(there)
        for a in src[1:]:
            src[0] = src[0].unionByName(a)
        for a in dst[1:]:
            dst[0] = dst[0].unionByName(a)
        data = R.compare_counts_max(src[0], dst[0], ["db", "tbl"], ["id", "version"], [])
        return R.mismatch_report(self.names, self.spark.createDataFrame(list(there), "db string, tbl string"), data_report=data)

    def reload(self, report, run, **options):
        self.reads.clear()
        out = RL.reload_tables(report, self.columns, self.read, self.at("export"), self.at("target"), self.at("quarantine"),
                               self.at("journal"), run, **options)
        return {r.table_name: (r.state, r.loaded) for r in out.collect()}


@pytest.fixture()
def house(spark, tmp):
    w = Warehouse(spark, tmp)
    w.put("a", "t1", w.source["a", "t1"].filter("id % 7 <> 3"))
    w.put("a", "t2", w.source["a", "t2"])
    w.put("b", "t1", w.source["b", "t1"].withColumn("version", F.lit(0)))
    return w


def test_listed_tables_are_reloaded_and_the_rest_untouched(spark, house):
    untouched = G.current(spark, RL.target_path(house.at("target"), "a", "t2"))
    files = sorted((f, os.stat(os.path.join(untouched, f)).st_mtime_ns) for f in os.listdir(untouched))
    assert [r.table_name for r in house.report().collect()] == ["a.t1", "b.t1", "b.t3"]
    got = house.reload(house.report(), "r1", max_bytes=512)
    assert got == {"a.t1": ("loaded", 300), "b.t1": ("loaded", 20), "b.t3": ("loaded", 7)}
    assert sorted(house.reads) == ["a.t1", "b.t1", "b.t3"]
    assert house.report().count() == 0
    for key, df in house.source.items():
        loaded = RL.read_target(spark, house.at("target"), *key)
        assert loaded.schema == df.schema and sorted(loaded.collect()) == sorted(df.collect())
    assert sorted((f, os.stat(os.path.join(untouched, f)).st_mtime_ns) for f in os.listdir(untouched)) == files


def test_a_rerun_continues_and_a_failed_table_keeps_its_copy(spark, house):
    report = spark.createDataFrame(house.report().collect(), "table_name string")
    good = house.source["b", "t1"]
    house.source["b", "t1"] = good.withColumn("name", F.when(F.col("id") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    got = house.reload(report, "r1")
    assert got["a.t1"] == ("loaded", 300) and got["b.t1"][0].startswith("failed")
    assert RL.read_target(spark, house.at("target"), "b", "t1").select(F.max("version")).first()[0] == 0
    house.source["b", "t1"] = good
    got = house.reload(report, "r1")  # only what is not loaded yet
    assert house.reads == ["b.t1"] and got == {"a.t1": ("loaded", 300), "b.t1": ("loaded", 20), "b.t3": ("loaded", 7)}
    assert house.reload(report, "r1") == got and house.reads == []
    assert house.reload(report, "r2") == got and len(house.reads) == 3  # another run does all again
    assert house.report().count() == 0


def test_names_without_schema_are_reported(spark, house):
    report = spark.createDataFrame([("a.t2",), ("z.gone",)], "table_name string")
    assert house.reload(report, "r1") == {"a.t2": ("loaded", 50), "z.gone": ("no schema", 0)}
