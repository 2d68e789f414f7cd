"""Jaccard join against all pairs; components against union-find."""

import random
import re

import pytest
from awkward_tables import documents, story

from wareshift.llm import jaccard as J
from wareshift.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, n):
    out = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n
                   else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, n, percent):
    sets = sets_of(rows, n)
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r[0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r[0], len(s), low[find(i)] if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))), key=str), \
        len({find(i) for i in range(len(rows)) if sets[i]}) + sum(not s for s in sets)


def run(df, **options):
    found = J.jaccard_components(df, **options).collect()
    return sorted(((r["doc_id"], r.n_shingles, r.component_id) for r in found), key=str)


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    rnd = random.Random(2)
    rows = [(i, edited(rnd, story(80, i % 4), rnd.randrange(0, 4))) for i in range(120)]
    rows += [(200 + i, " ".join(story(12, 9)[: 9 + i % 4])) for i in range(12)]
    rows += [(300 + i, "The SAME text of a few words " * 2) for i in range(30)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"block": 4, "tile": 16}, {"n": 5, "percent": 80, "block": 8, "tile": 10}])
def test_near_copies(spark, copies, options):
    want, _ = brute(copies, options.get("n", 3), options.get("percent", 90))
    assert run(documents(spark, copies), **options) == want


def test_awkward_rows(awkward):
    rows, df = awkward
    assert run(df) == brute(rows, 3, 90)[0]


def test_empty_table(nothing):
    assert run(nothing) == []
    assert J.one_of_each(nothing).collect() == []


def test_one_of_each_keeps_one_row_of_a_group(spark, copies, awkward):
    df = documents(spark, copies)
    kept = J.one_of_each(df, n=5, percent=80)
    want, groups = brute(copies, 5, 80)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert len({c for _, _, c in want}) == groups
    rows, df = awkward
    assert J.one_of_each(df, n=5, percent=80).count() == brute(rows, 5, 80)[1]


def test_low_percentage_is_refused(nothing):
    with pytest.raises(ValueError):
        J.jaccard_components(nothing, percent=30)


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(120)]
    edges += [(2000, 2001 + i) for i in range(50)] + [(7, 7)]
    up = {}

    def find(i):
        up.setdefault(i, i)
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        if a != b and x != y:
            up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: find(i) for a, b in edges if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.fixture
def tables(monkeypatch):
    """Names and row counts of the tables that an operator writes."""
    found = {}
    written = J.written

    def keep(df, name, *args, **options):
        out = written(df, name, *args, **options)
        found[name] = out.count()
        return out

    monkeypatch.setattr(J, "written", keep)
    return found


def test_sets_that_share_some_shingles_are_no_candidates(spark, tables):
    rnd = random.Random(11)
    phrases = [" ".join(f"p{i}x{j}" for j in range(30)) for i in range(8)]
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(60)) + " " + phrases[i % 8]) for i in range(160)]
    rows += [(1000 + i, edited(rnd, rows[i][1].split(), 1)) for i in range(6)]
    # without a table of frequent shingles those of the phrases are in many prefixes
    assert run(documents(spark, rows), table=0) == brute(rows, 3, 90)[0]
    assert 6 <= tables["candidates"] <= 12 and tables["members"] == 12


@pytest.mark.parametrize("crowd", [3, 2048])
def test_blocks_of_many_classes(spark, copies, tables, crowd):
    assert run(documents(spark, copies), block=2, crowd=crowd, table=0, tile=16) == brute(copies, 3, 90)[0]


def test_a_block_of_many_unlike_sets_ties_none(spark, tables):
    rows = [(i, f"one two three four five six a{i} b{i} c{i} d{i} e{i} f{i} g{i} h{i}") for i in range(90)]
    assert run(documents(spark, rows), block=16, table=0) == brute(rows, 3, 90)[0]
    assert tables["prefix-posts"] > 4 * 16 and tables["candidates"] == 0


def test_only_rows_that_may_go_are_shuffled_whole(spark, monkeypatch):
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(20))) for i in range(50)]
    rows += [(60, rows[7][1]), (61, rows[8][1]), (9, rows[9][1]), (70, None), (70, None)]
    passed, few = J.passed, []

    def keep(df, value, bits, how="left_semi"):
        out = passed(df, value, bits, how)
        if "row" in df.columns and how == "left_semi":
            few.append(out.count())
        return out

    monkeypatch.setattr(J, "passed", keep)
    assert sorted((r.doc_id for r in J.one_of_each(documents(spark, rows), n=5, percent=80).collect())) == [
        *range(50), 70, 70]
    assert few == [4]  # 60, 61 and both of 9


def test_bit_filter(spark):
    from wareshift.llm.bitfilter import bit_filter, passed

    rnd = random.Random(5)
    values = [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(3000)] + [-1, 0, (1 << 63) - 1, -(1 << 63)]
    df = spark.createDataFrame([([v, v] if i % 3 else [v],) for i, v in enumerate(values)], "h array<bigint>")
    asked = spark.createDataFrame([(v,) for v in values] + [(v ^ (1 << 50),) for v in values], "v bigint")
    for least in (1, 2):
        bits = bit_filter(df, least)
        want = {v for i, v in enumerate(values) if least == 1 or i % 3}
        got = {r.v for r in passed(asked, asked.v, bits).collect()}
        assert got >= want and len(got - want) < len(values) // 8
        assert {r.v for r in passed(asked, asked.v, bits, "left_anti").collect()} == {r.v for r in asked.collect()} - got
    assert passed(asked, asked.v, bit_filter(df.where("false"))).count() == 0
    halves = df.select("h").repartition(7).selectExpr("explode(h) AS h")
    assert passed(asked, asked.v, bit_filter(halves, 2)).count() >= len([i for i in range(len(values)) if i % 3])
