import datetime as dt

from pyspark.sql import functions as F

from wareshift.functions import scalars as S
from wareshift.plans.reports import JUNK_DATES


def test_junk_dates_are_null_and_loose_forms_parse(spark):
    good = ["2021-12-7", "2022-05-18 22:48:02.666", "2022-05-19 03:57:44.1000"]
    rows = [(i, v) for i, v in enumerate(JUNK_DATES + good + [None])]
    df = spark.createDataFrame(rows, "id int, raw string")
    out = {r.id: (r.p, r.q) for r in df.select("id", S.lenient_timestamp("raw").alias("p"),
                                                 S.is_junk_timestamp("raw").alias("q")).collect()}
    n = len(JUNK_DATES)
    for i in range(n):
        assert out[i] == (None, True), JUNK_DATES[i]
    assert out[n][0] == dt.datetime(2021, 12, 7)
    assert out[n + 1][0] == dt.datetime(2022, 5, 18, 22, 48, 2, 666000)
    assert out[n + 2][0] == dt.datetime(2022, 5, 19, 3, 57, 44, 100000)
    assert out[n + 3] == (None, False)


def test_round_to_second_half_away_from_zero(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 7, 500000),), (dt.datetime(2024, 1, 1, 0, 0, 7, 499999),),
            (dt.datetime(1960, 1, 1, 0, 0, 7, 500000),), (dt.datetime(1960, 1, 1, 0, 0, 7, 500001),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(S.round_to_second("ts")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 8), dt.datetime(2024, 1, 1, 0, 0, 7),
                   dt.datetime(1960, 1, 1, 0, 0, 7), dt.datetime(1960, 1, 1, 0, 0, 8)]


def test_lenient_numbers_and_ifnull(spark):
    df = spark.createDataFrame([("1.5", None), ("x", 3), ("", None)], "s string, n int")
    got = df.select(S.lenient_double("s").alias("d"), S.lenient_bigint("s").alias("b"),
                    S.ifnull("n", 0).alias("f"), S.nullvalue("n").alias("z")).collect()
    assert [tuple(r) for r in got] == [(1.5, None, 0, True), (None, None, 3, False), (None, None, 0, True)]


def test_calendar_helpers(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 15),), (dt.date(2021, 12, 31),)], "d date")
    got = df.select(S.prev_month_start("d"), S.next_month_start("d"), S.date_key("d"),
                    S.quarter_of_month(F.month("d"))).collect()
    assert tuple(got[0]) == (dt.date(2020, 12, 1), dt.date(2021, 2, 1), "20210115", 1)
    assert tuple(got[1]) == (dt.date(2021, 11, 1), dt.date(2022, 1, 1), "20211231", 4)
