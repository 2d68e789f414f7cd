"""Folding, matching, exceptions and held-out accuracy."""

import math
import zlib

import pytest
from awkward_tables import documents, story

from wareshift.llm import toxicity as X


@pytest.mark.parametrize("spelled", ["idiot", "IDIOT", "1d1ot", "id!ot", "i.d.i.o.t", "іdіоt", "idiooooot", "ｉｄｉｏｔ", "idi​ot",
                                     "idiot!!!", "i_d-i*o_t"])
def test_fold_of_altered_spellings(spelled):
    assert X.fold(spelled) == ["idiot"]


def test_fold_leaves_plain_words_and_numbers():
    assert X.fold("The 2024 élan, 100 % x") == ["the", "élan", "x"]
    assert X.fold("") == [] and X.fold(" \n ") == []


def test_hits_count_a_word_once_and_respect_exceptions():
    model = X.Model({" idio": 1.0, " idiot ": 2.0, " scum": 1.5}, frozenset({" scum bucket "}))
    auto = model.matcher()
    words = X.fold("An idiot and idiocy in the scum bucket and scum")
    assert X.hits(words, auto, frozenset()) == [(1, 2.0), (3, 1.0), (6, 1.5), (9, 1.5)]
    assert X.hits(words, auto, model.exceptions) == [(1, 2.0), (3, 1.0), (9, 1.5)]
    assert X.hits([], auto, model.exceptions) == [] and X.hits(["unidiot"], auto, frozenset()) == []
    assert X.hits(["1d!ocy", "sc.um"], auto, frozenset()) == [(0, 1.0), (1, 1.5)]


def test_phrases_and_spelled_out_words_match():
    model = X.Model({" idiot ": 2.0, " go home ": 3.0, " go ": 1.0}, frozenset({" lovely idiot "}))
    auto = model.matcher()
    at = lambda text: X.hits(X.split(text), auto, model.exceptions)
    assert at("please go home now") == [(1, 3.0)] and at("let it go") == [(2, 1.0)] and at("going home") == []
    assert at("you I D I O T there") == [(1, 2.0)] and at("you i. d. i. o. t. there") == [(1, 2.0)]
    assert at("a lovely 1diot") == [] and at("a lovely lovely idiot, idiot") == [(4, 2.0)]
    assert X.fold("a b see a b c") == ["a", "b", "see", "abc"]


def plain_score(text, model):
    """The score from the rules as stated: fold, find every entry and phrase
    at every word, leave out what lies in a phrase, heaviest per word, curve."""
    words = (text or "").lower().split()
    folded = [w for w in map(X.fold_word, words) if w]
    at = 0
    while at < len(folded):  # spelled-out words
        run = at
        while run < len(folded) and len(folded[run]) == 1 and folded[run].isalpha():
            run += 1
        if run - at >= 3:
            folded[at:run] = [X.fold_word("".join(folded[at:run]))]
        at += 1
    silent = set()
    for i, (a, b) in enumerate(zip(folded, folded[1:])):
        if f" {a} {b} " in model.exceptions:
            silent |= {i, i + 1}
    weights = []
    for i in range(len(folded)):
        rest = f" {' '.join(folded[i : i + 6])} "
        here = [w for t, w in model.terms.items() if rest.startswith(t)]
        if here and i not in silent:
            weights.append(max(here))
    if not model.curve:
        return 0.0, 0
    total = sum(weights)
    z = model.curve[0] + model.curve[1] * math.log1p(total) + model.curve[2] * math.log1p(100 * total / max(len(words), 100))
    return 1 / (1 + math.exp(-min(max(z, -60), 60))), len(weights)


def test_all_rows_equal_a_plain_scorer(spark, labelled, awkward):
    model = X.learn(labelled[1], labelled[2])
    assert model.exceptions
    rows = labelled[0] + [(i, t) for i, t, *_ in awkward[0]] + [
        (-1, "b l o r g u l"), (-2, "zanfika garden zanfika"), (-3, "zanfika, garden; ZANFIKA!!! bl0rgul"), (-4, "blorgul " * 500)]
    df = documents(spark, [(i, t) for i, t in rows])
    got = [(r.row.doc_id, r.score, r.n_hits) for r in X.score_documents(df.repartition(3), model, ["doc_id"]).collect()]
    want = [(i, *plain_score(t, model)) for i, t in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[1], 9))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[0] == w[0] and g[2] == w[2] and g[1] == pytest.approx(w[1], rel=1e-9)


def test_query_equals_a_plain_scorer(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = X.learn(docs.select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: (r.score, r.predicted, r.held_out) for r in E.queries()["op9_toxicity"](spark, sf).collect()}
    assert len(got) == docs.count()
    for r in docs.select("doc_id", "text").collect():
        score = plain_score(r.text, model)[0]
        assert got[r.doc_id] == (pytest.approx(score, rel=1e-9), int(score >= 0.7), zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_column_names_of_any_kind(spark, labelled):
    model = X.learn(labelled[1], labelled[2])
    df = documents(spark, [(1, "fine words"), (2, "bl0rgul zanfika " * 9)]).selectExpr(
        "doc_id", "text", "1 as none", "2 as `my col`", "3 as `a.b`", "4 as row", "5 as score", "6 as predicted", "array(7) as n_hits")
    kept = X.acceptable_documents(df, model)
    assert kept.columns == df.columns
    assert [tuple(r) for r in kept.collect()] == [(1, "fine words", 1, 2, 3, 4, 5, 6, [7])]
    only = X.acceptable_documents(df.select("text"), model)
    assert [r.text for r in only.collect()] == ["fine words"]


def test_long_texts_need_more_hits():
    one = [(1, 3.0)]
    assert X.measures(one, 5) == X.measures(one, 100) > X.measures(one, 1000)
    assert X.score((), 1.0, 1.0) == 0.0 and 0 < X.score((-3.0, 1.0, 1.0), 0.0, 0.0) < 0.5


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = [], []
    for i in range(600):
        w = story(40, i)
        if i % 5 == 0:
            w[3] = "blorgul" if i % 2 else "bl0rgul!"
            w[9] = "zanfik" + "aeiou"[i % 5]
        elif i % 7 == 0:
            w[3:5] = ["zanfika", "garden"]  # harmless in this phrase
        rows.append((i, " ".join(w)))
        labels.append((i, i % 2, int(i % 5 == 0), "y"))
    labels += [(0, 1, 1, "again"), (None, 0, 1, "n"), (5000, 0, 1, "no document"), (7, 0, None, "unknown")]
    return rows, documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


def test_learned_lexicon(labelled):
    rows, df, labels = labelled
    model = X.learn(df, labels)
    assert any(t.startswith(" blor") for t in model.terms)
    assert any("garden" in p for p in model.exceptions)
    got = {r.row.doc_id: r.predicted for r in X.score_documents(df, model, ["doc_id"]).collect()}
    wrong = [i for i, _ in rows if got[i] != int(i % 5 == 0)]
    assert len(wrong) <= 6
    kept = X.acceptable_documents(df, model)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in rows if not got[i]]


def test_awkward_rows_and_missing_labels(spark, awkward, labelled, nothing):
    rows, df = awkward
    model = X.learn(labelled[1], labelled[2])
    got = X.score_documents(df, model, ["doc_id", "row"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score < 0.7 and r.predicted == 0 for r in got)
    none = X.learn(df, labelled[2].limit(0))
    assert none.terms == {} and X.acceptable_documents(df, none).count() == len(rows)
    assert X.learn(nothing, labelled[2]).terms == {}
    assert X.score_documents(nothing, model, ["doc_id"]).collect() == []


def test_bounded_sample(labelled):
    _, df, labels = labelled
    rows = X.training_rows(df, labels, 100, "doc_id", "text")
    assert 40 < rows.count() <= 110


def test_held_out_accuracy_on_the_table(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.1"
    found = E.queries()["op9_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = found.where("held_out").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.005 * len(clean)
