"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from wareshift.llm import ann as A


def frame(spark, rows):
    return spark.createDataFrame([(v, i, "q", 1) for i, v in rows],
                                 "embedding array<float>, vec_id bigint, bucket string, t int")


def brute(rows, every, k):
    seen = {}
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fine.setdefault(i, np.array(v, np.float32).astype(float))
    for q in fine:
        if q % every == 0:
            near = sorted((float(np.sqrt(((v - fine[q]) ** 2).sum())), i) for i, v in fine.items() if i != q)
            seen[q] = near[:k]
    return seen


def run(df, **options):
    out = {}
    for r in A.nearest_neighbours(df, **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return {q: [(s, i) for _, s, i in sorted(v)] for q, v in out.items()}


def same(got, want):
    assert set(got) == {q for q, v in want.items() if v}
    for q in got:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12, atol=0)


def test_unusable_vectors_and_ties(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(i, v) for i in range(30)] + [(100, [1.0, 2.0, 4.0]), (101, [1.0, 2.0, 2.0]), (0, v)]
    rows += [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 1.0]), (203, [1.0, float("nan"), 1.0]),
             (204, [float("inf"), 1.0, 1.0]), (None, v)]
    same(run(frame(spark, rows), query_every=5, k=4, mass=0.999999), brute(rows, 5, 4))


@pytest.mark.parametrize("block", [2, 2048])
def test_an_id_with_several_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(A, "QUERY_BLOCK", block)
    rows = [(100, [5.0, 0.0]), (100, [1.0, 0.0]), (200, [1.5, 0.0]), (200, [6.0, 0.0]), (300, [2.0, 0.0]), (7, [4.5, 0.0])]
    got = run(frame(spark, rows).repartition(3), query_every=100, k=3, mass=0.999999)
    assert got[100] == [(0.5, 200), (1.0, 300), (3.5, 7)]  # asks from its smallest vector, [1, 0]
    assert got[200] == [(0.5, 100), (0.5, 300), (3.0, 7)]  # from [1.5, 0]
    assert got[300] == [(0.5, 200), (1.0, 100), (2.5, 7)]  # met at their nearest


def test_a_hot_vector_sends_few_rows(spark):
    v = [0.5, 1.0, -2.0]
    rows = [(i, v if i % 3 else [float(i), 1.0, 2.0]) for i in range(900)] + [(4, v)] * 50
    made = A.entries(A.usable(frame(spark, rows), "vec_id", "embedding"), 4)
    found = {tuple(r.v): r.ids for r in made.collect()}
    assert len(found) == 301 and found[tuple(v)] == [1, 2, 4, 5]
    assert "WindowGroupLimit" in made._jdf.queryExecution().executedPlan().toString()


def test_fewer_candidates_than_asked(spark):
    rows = [(i * 10, [float(i), 1.0]) for i in range(1, 6)] + [(7, [50.0, -3.0])]
    same(run(frame(spark, rows), query_every=10, k=10), brute(rows, 10, 10))


def test_sparse_buckets_are_searched_exactly(spark, monkeypatch):
    monkeypatch.setattr(A, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(8) * 10 ** (i % 5)).tolist()) for i in range(300)]
    got = run(frame(spark, rows), query_every=60, k=5, tables=1, mass=1e-9)
    assert all(len(v) == 5 for v in got.values()) and set(got) == {0, 60, 120, 180, 240}


@pytest.mark.parametrize("options", [{}, {"block": 16}])
def test_recall(spark, options):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 32))
    rows = [(i, (centres[i % 20] + 0.4 * rng.standard_normal(32)).tolist()) for i in range(2000)]
    want = brute(rows, 50, 10)
    got = run(frame(spark, rows), query_every=50, k=10, **options)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert set(got) == set(want) and hit >= 0.9 * sum(map(len, want.values()))
    for q in got:
        assert got[q] == sorted(got[q]) and len(got[q]) == 10 and q not in {i for _, i in got[q]}


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, 100, 10)
    got = run(df, query_every=100, k=10)
    assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_empty_table(spark):
    assert run(frame(spark, [(1, None)]).limit(0), query_every=10) == {}
    assert run(frame(spark, [(1, None)]), query_every=1) == {}


def test_probes_come_in_order_of_chance():
    t = A.Tables(8, 10_000, np.random.default_rng(1).standard_normal((200, 8)), tables=1, seed=3)
    place = t.places(np.ones((1, 8)))[0]
    cells = t.probes(place, 0.9)
    assert (cells[0] == np.floor(place)).all() and len({tuple(c) for c in cells}) == len(cells)

    def chance(cell):
        edge = lambda e: 0.5 * math.erfc(-(e * t.w / t.d) / math.sqrt(2))
        return math.prod(edge(c + 1 - x) - edge(c - x) for c, x in zip(cell, place))

    found = [chance(c) for c in cells]
    assert all(a >= b - 1e-12 for a, b in zip(found, found[1:])) and 0.9 <= sum(found) < 1
