"""Source mix: targets against a step-by-step sharing, copies against the
definition of systematic sampling."""

import collections
import hashlib
import math
import random
import re

import pytest
from awkward_tables import documents, story

from wareshift.llm.mixing import mix_documents, plan_mix, source_targets


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Give every source its part, take what is above its cap, share it again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal = dict.fromkeys(names, 0.0)
    rest, open_ = share * sum(sizes.values()), set(names)
    while rest > 1e-9 and open_:
        all_w = sum(w[s] for s in open_)
        part = {s: rest * w[s] / all_w for s in open_}
        rest = 0.0
        for s, more in part.items():
            goal[s] += more
            if goal[s] >= cap * sizes[s]:
                rest += goal[s] - cap * sizes[s]
                goal[s] = cap * sizes[s]
                open_.discard(s)
    return goal


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}é"[: rnd.randrange(2, 4)]: rnd.choice([0, 1, 5, 1000, rnd.randrange(10**6)]) for i in range(12)}
    sizes[None] = 77
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in source_targets(df, (3, 1, 2), 1.5, 2.0).collect()}
    want = targets(sizes)
    assert set(got) == set(want)
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)


@pytest.fixture(scope="module")
def mixed(spark):
    rnd = random.Random(8)
    sources = ["hot"] * 12 + ["a", "b", "é", None]
    rows = [(i, " ".join(story(rnd.choice([0, 1, 3, 20, 60]), i)), rnd.choice(sources)) for i in range(400)]
    rows += [(1000 + i, "same words here", "hot") for i in range(100)] + [(2000, None, "z"), (None, "no id", "a")]
    return rows, documents(spark, rows).repartition(7)


def test_copies(mixed):
    rows, df = mixed
    got = plan_mix(df, ["doc_id", "source"]).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += words(t)
    goal = targets(size)
    taken = collections.Counter()
    by = collections.defaultdict(list)
    for r in got:
        assert r.source_size == size[r.row.source]
        assert r.target == pytest.approx(goal[r.row.source])
        assert r.copies in (0, 1, 2)
        taken[r.row.source] += r.copies * r["size"]
        by[r.row.source].append(r)
    for s, rs in by.items():
        largest = max(r["size"] for r in rs)
        assert abs(taken[s] - goal[s]) <= max(largest, 1)
        rs.sort(key=lambda r: (r["size"], r.row.doc_id is not None, r.row.doc_id or 0))
        u = int(hashlib.md5(("0:" + ("null" if s is None else "=" + s)).encode()).hexdigest()[:8], 16) / 2**32
        e = goal[s] / size[s] if size[s] else 0
        want = [math.floor(u + k * e + 1e-9) - math.floor(u + (k - 1) * e + 1e-9) for k in range(1, len(rs) + 1)]
        assert [r.copies for r in rs] == want


def test_reruns_and_other_partitions_agree(mixed):
    _, df = mixed
    one, two = (sorted((str(r.row.doc_id), r.copies) for r in plan_mix(d, ["doc_id"]).collect())
                for d in (df, df.repartition(3)))
    assert one == two


def test_documents_once_per_copy(mixed):
    _, df = mixed
    plan = {r.row.doc_id: r.copies for r in plan_mix(df, ["doc_id"]).collect()}
    out = mix_documents(df)
    assert out.columns == df.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == {d: c for d, c in plan.items() if c}


def test_empty_tables_and_wordless_sources(spark, nothing):
    assert plan_mix(nothing, ["doc_id"]).collect() == []
    got = plan_mix(documents(spark, [(1, ""), (2, None)]), ["doc_id"]).collect()
    assert [(r.copies, r.target) for r in got] == [(0, 0.0), (0, 0.0)]
