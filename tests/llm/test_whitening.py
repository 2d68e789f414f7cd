"""Whitening against exact sums and a plain fit of all rows."""

import math
from collections import Counter

import numpy as np
import pytest

from wareshift.llm import whitening as W


def frame(spark, rows):
    return spark.createDataFrame([(v, i, "q", 1, b"k") for i, v in rows],
                                 "embedding array<float>, vec_id bigint, x string, n int, key binary")


def plain(rows, weights="counts", top=32):
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    if not fine:
        return {}
    length = max(Counter(len(v) for _, v in fine).items(), key=lambda kv: (kv[1], kv[0]))[0]
    fine = [(i, tuple(int(math.floor(64 * c)) + 1_000_000 for c in v)) for i, v in fine if len(v) == length]
    fit = [x for _, x in fine] if weights == "counts" else sorted({x for _, x in fine})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = {x: np.array([(n * a - s) / n for a, s in zip(x, sums)]) for x in set(fit)}
    y = np.array([centred[x] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = [j for j in np.argsort(-values) if values[j] > 1e-12 * max(values.max(), 0)][:top]
    return {"n": n, "values": values[order], "trace": values.sum(), "rows": [
        (i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), centred[x] @ vectors[:, order] / np.sqrt(values[order]))
        for i, x in fine]}


def compare(df, rows, loose=1e-7, **options):
    want = plain(rows, options.get("weights", "counts"))
    got = W.whiten(df, **options).collect()
    if not want or not len(want["values"]):
        assert got == []
        return got
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got_rows = sorted(((r.vec_id, int(r.deviation_exact), np.array(r.whitened)) for r in got), key=key)
    want_rows = sorted(want["rows"], key=key)
    assert [r[:2] for r in got_rows] == [r[:2] for r in want_rows]
    assert all(r.n == want["n"] and r.identity_error < 1e-4 for r in got)
    assert all((r.deviation == int(r.deviation_exact)) if int(r.deviation_exact) < 2**63 else r.deviation is None for r in got)
    assert np.allclose(got[0].explained, want["values"] / want["trace"], rtol=1e-9)
    a, b = np.array([r[2] for r in got_rows]), np.array([r[2] for r in want_rows])
    gaps = np.diff(want["values"]) < -1e-6 * want["values"][0]
    for j in range(a.shape[1]):  # either sign, where the eigenvalue stands alone
        if (j == 0 or gaps[j - 1]) and (j == a.shape[1] - 1 or gaps[j]):
            assert min(np.abs(a[:, j] - b[:, j]).max(), np.abs(a[:, j] + b[:, j]).max()) < loose
    return got


def vectors(n, dim, seed, spread=1.0):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, dim)) * np.linspace(0.2, 2, dim) * spread).astype(np.float32)


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_repeated_vectors_count(spark, weights):
    v = vectors(40, 5, 1).tolist()
    rows = [(i, v[i % 40]) for i in range(100)] + [(1000 + i, v[0]) for i in range(200)] + [(1000, v[0])]
    compare(frame(spark, rows).repartition(7), rows, weights=weights)


def test_rows_that_take_no_part(spark):
    v = vectors(30, 4, 2).tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [
        (100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, math.nan, 2.0, 3.0]),
        (104, [math.inf, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (None, v[3]), (None, v[4]), (5, v[6]), (200, [0.0] * 4)]
    got = compare(frame(spark, rows), rows)
    assert {r.vec_id for r in got} == set(range(30)) | {None, 200}


def test_far_entries_do_not_crash(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1e9, 2.0]), (4, [0.5, 3.0])]
    got = W.whiten(frame(spark, rows)).collect()
    assert len(got) == 4 and all(r.deviation_exact.isdigit() for r in got)


def test_degenerate(spark):
    compare(frame(spark, [(1, [1.0, 2.0])]), [(1, [1.0, 2.0])])
    same = [(i, [0.25, 0.5, 1.0]) for i in range(9)]
    compare(frame(spark, same), same)
    line = [(i, [0.25 * i, 0.5 * i, 3.0]) for i in range(9)]  # one component only
    assert all(len(r.whitened) == 1 for r in compare(frame(spark, line), line))
    compare(frame(spark, []), [])
    nulls = [(1, None), (2, [])]
    compare(frame(spark, nulls), nulls)


def test_exact_deviation_of_wide_spreads():
    x = np.array([[1 << 41, -(1 << 41), 5], [7, 8, 9], [-3, 1 << 40, 0]], np.int64)
    n, sums = 10**11 + 7, [123456789012345678, -98765432109876543, 17]
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert W._deviation(x, n, sums) == want


def test_components_as_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    compare(df, rows, loose=1e-6)
    long = W.by_component(W.whiten(df, components=32)).collect()
    assert {r.component for r in long} == set(range(1, 33)) and len(long) == 32 * len(rows)
    first = [r for r in long if r.component == 1]
    second = [r for r in long if r.component == 2]
    assert first[0].explained >= second[0].explained
    assert abs(sum(r.whitened for r in first) / len(first)) < 1e-9
    assert abs(sum(r.whitened**2 for r in first) / len(first) - 1) < 1e-9


def test_a_hot_vector_is_counted_before_the_shuffle(spark):
    hot = [0.5, 0.25, 0.125]
    rows = [(i, hot if i % 3 else [float(i % 11), float(i % 7), 1.0 / (1 + i % 5)]) for i in range(3000)]
    compare(frame(spark, rows).repartition(6), rows)
