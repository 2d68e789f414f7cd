"""The pipeline's stages against the operators' brute-force versions."""

import collections


import pytest
from test_decontaminate import brute as contained
from test_jaccard import brute as linked
from test_token_ids import library_rows

import corpus_pipeline as P
from wareshift.llm.toxicity import learn, score_documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents and what run() wrote after each stage."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    written = P.written

    def keep(df, name):
        out.append(written(df, name))
        return out[-1]

    P.written = keep
    try:
        P.run(spark, SF)
    finally:
        P.written = written
    assert len(out) == 1 + len(P.STAGES)
    return out


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxicity(spark, stages):
    model = learn(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.row.doc_id for r in score_documents(stages[0], model, ["doc_id"]).collect() if r.predicted}
    assert {r[0] for r in rows(stages[1])} == {r[0] for r in rows(stages[0])} - bad


def test_near_duplicates(stages):
    before = rows(stages[1])
    want, _ = linked(before, 5, 80)
    assert sorted(r[0] for r in rows(stages[2])) == sorted({c for _, _, c in want})


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(stages[2])
    bad = {d for d, *_ in contained(before, items)}
    assert bad and sorted(r[0] for r in rows(stages[3])) == sorted(r[0] for r in before if r[0] not in bad)


def test_mix(stages):
    before, after = collections.Counter(rows(stages[3])), collections.Counter(rows(stages[4]))
    assert set(after) <= set(before) and max(after.values()) <= 2
    words = sum(len(t.split()) * n for (_, t, _), n in after.items())
    assert words == pytest.approx(1.5 * sum(len(t.split()) for _, t, _ in before), rel=0.1)


def test_token_ids(stages):
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in stages[5].collect())
    assert got == sorted(r[:4] for r in library_rows(rows(stages[4]), 2))


def test_awkward_rows_pass_all_stages(spark, awkward):
    _, df = awkward
    for _, stage in P.STAGES:
        df = stage(spark, df, SF)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and df.count() > 0


def test_column_names_of_any_kind_pass_all_stages(spark, small_documents):
    df = small_documents[1].limit(60).selectExpr("*", "1 as none", "2 as `my col`", "3 as `a.b`", "4 as row", "5 as k1", "6 as copy")
    names = df.columns
    for name, stage in P.STAGES[:-1]:
        df = P.written(stage(spark, df, SF), name)
        assert df.columns == names
        assert {tuple(r)[-6:] for r in df.collect()} <= {(1, 2, 3, 4, 5, 6)} and df.count() > 0
    assert P.STAGES[-1][1](spark, df, SF).count() == df.count()


def test_of_equal_rows_the_same_one_stays(spark):
    from wareshift.llm.jaccard import one_of_each

    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, c) for c in "dbca"] + [(2, text, "e"), (3, None, "f"), (3, None, "g")]
    kept = set()
    for n in (1, 3, 7):
        df = spark.createDataFrame(rows[::-1] if n == 3 else rows, "doc_id bigint, text string, c string").repartition(n)
        kept.add(tuple(sorted(map(str, one_of_each(df, n=5, percent=80).collect()))))
    assert len(kept) == 1 and len(next(iter(kept))) == 3


def test_empty_table_passes_all_stages(spark, nothing):
    df = nothing
    for _, stage in P.STAGES:
        df = stage(spark, df, SF)
    assert df.count() == 0
