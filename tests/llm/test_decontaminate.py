"""Containment search against sets of shingles."""

import random
import re

import pytest
from awkward_tables import documents, story

from wareshift.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").lower())


def brute(rows, items, threshold=0.8):
    out = []
    for doc, text, *_ in rows:
        w = words(text)
        for item, it in items:
            x = words(it)
            n = min(len(x), 5)
            if n:
                want = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}
                both = len(want & {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
                if both * 1000 >= round(threshold * 1000) * len(want):
                    out.append((doc, item, both, len(want)))
    return sorted(out, key=str)


def run(df, bench, **options):
    found = D.mark(df, bench, ["doc_id"], **options).collect()
    return sorted(((r.row.doc_id, i.item_id, i.shared, i.size) for r in found for i in r["items"]), key=str)


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(4)
    items = [(i, " ".join(story(n, 100 + i))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 9, 15, 30, 31, 40, 64, 130] * 2)]
    items += [(500, None), (501, ""), (502, "..."), (7, items[8][1])]
    rows = []
    for i in range(150):
        body = story(rnd.choice([0, 3, 50, 400]), 10_000 + i)
        if i % 2:
            part = words(rnd.choice(items)[1])
            for _ in range(rnd.randrange(0, 4)):
                if part:
                    part[rnd.randrange(len(part))] = "other"
            at = rnd.randrange(len(body) + 1)
            body[at:at] = [w.upper() + rnd.choice(["", ",", "!"]) for w in part]
        rows.append((i, " ".join(body)))
    return rows, items, documents(spark, rows), spark.createDataFrame(
        [(t, i, "x") for i, t in items], "text string, item_id bigint, items string")


@pytest.mark.parametrize("options", [{}, {"block_shingles": 100}, {"threshold": 0.5}])
def test_planted_items(planted, options):
    rows, items, df, bench = planted
    want = brute(rows, items, options.get("threshold", 0.8))
    assert len(want) > 20
    assert run(df, bench, **options) == want


def test_clean_documents_stay_whole(planted):
    rows, items, df, bench = planted
    bad = {d for d, *_ in brute(rows, items)}
    kept = D.clean_documents(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text, r.row) for r in kept.collect()) == sorted((d, t, "r") for d, t in rows if d not in bad)


def test_awkward_rows(spark, awkward):
    rows, df = awkward
    items = [(1, rows[0][1]), (2, "one two"), (3, "日本語")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert run(df, bench) == brute(rows, items)
    assert D.clean_documents(df, bench).count() == len(rows) - len({i for i, r in enumerate(rows) if brute([r], items)})


def test_awkward_rows_against_a_large_benchmark(spark, awkward):
    rows, df = awkward
    items = [(1, rows[0][1]), (2, "one two"), (3, "日本語"), (2, "one two"), (4, None), (5, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert run(df.repartition(3), bench, block_shingles=1) == brute(rows, items)
    odd = df.selectExpr("doc_id", "text", "1 as k1", "2 as `my col`", "3 as `a.b`", "4 as none", "5 as n", "6 as no", "7 as items")
    kept = D.clean_documents(odd, bench, block_shingles=1)
    assert kept.columns == odd.columns
    assert kept.count() == len(rows) - len({i for i, r in enumerate(rows) if brute([r], items)})
    assert all(tuple(r)[2:] == (1, 2, 3, 4, 5, 6, 7) for r in kept.collect())
    plan = D.mark(df, bench, ["doc_id"], block_shingles=1)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan


def test_empty_tables(spark, nothing, awkward):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert run(awkward[1], bench) == []
    assert D.clean_documents(awkward[1], bench).count() == len(awkward[0])
    assert run(nothing, spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")) == []
