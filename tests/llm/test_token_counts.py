"""Token counts against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from wareshift.llm import token_counts as C

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return C.merges(MODEL)


ALPHABETS = ["abcdefghij ", "the and ing  ▁", "aA0 \n\t", "日本語한é🙂 x", "ab", "a", "  x", "<s></>▁ the", " ▁t",
             "".join(map(chr, range(32, 127))), "".join(chr(c) for c in range(0x80, 0x2200, 7))]


def test_random_texts(library, model):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(a) for _ in range(rnd.choice([0, 1, 2, 5, 20, 100, 300])))
             for a in ALPHABETS for _ in range(250)]
    assert model.count(texts).tolist() == [len(x) for x in library.encode(texts)]


def test_runs_and_long_sequences(library, model):
    rnd = random.Random(2)
    texts = [" " * k for k in range(70)] + ["x" + " " * k + "the" for k in range(40)]
    texts += ["a" * 5000, "ab" * 3000, "".join(rnd.choice("abcXYZ019+/") for _ in range(30000)), "word " * 9000]
    assert model.count(texts).tolist() == [len(x) for x in library.encode(texts)]


def test_long_texts_are_cut_between_pieces(library, model, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_CHARS", 50)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab  é") for _ in range(n)) for n in (49, 50, 51, 300, 2000)]
    assert model.count(texts).tolist() == [len(x) for x in library.encode(texts)]


def test_cache_of_few_slots(library, monkeypatch):
    monkeypatch.setattr(C, "CACHE_BITS", 3)
    tight = C.PieceMerges(MODEL)
    texts = ["the cat sat on the mat", "hello hello hello", "mat mat the sat"] * 3
    assert tight.count(texts).tolist() == [len(x) for x in library.encode(texts)]


def test_clashing_fingerprints_stay_apart():
    sym = np.array([1, 2, 1, 2, 3, 4], np.int32)
    which, first, _ = C._distinct(sym, np.array([0, 2, 4]), np.array([2, 2, 2]))
    assert which[0] == which[1] != which[2] and len(first) == 2


def test_rows(awkward, library):
    rows, df = awkward
    got = C.token_counts(df, MODEL, limit=100)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for doc, text, *_ in rows:
        n = len(library.encode(text or ""))
        want.append((doc, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(nothing):
    assert C.token_counts(nothing, MODEL, limit=1).collect() == []


def test_small_table(small_documents, library):
    rows, df = small_documents
    got = {r.doc_id: r.n_tokens for r in C.token_counts(df, MODEL, 4096).collect()}
    assert got == {d: len(library.encode(t)) for d, t, _ in rows}
