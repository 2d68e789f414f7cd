"""Forced-boundary BPE: ids and decoded texts against the library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from awkward_tables import documents
from tokenizers import Tokenizer

from wareshift.llm import bpe

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def nasty():
    rnd = random.Random(3)
    alphabets = ["abc 's 't ", "the And \n\t'll", "日本語한é🙂 x́", "A Σσς 12½", "<|endoftext|> x", "\x1c\x85 a\x0b\x0c　",
                 "ÀÉß×÷ÿ a1", "".join(chr(c) for c in range(33, 0x2100, 5)) + " ", "qzxjkvw", "\x00\x7f a"]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.choice([0, 1, 2, 5, 20, 100]))) for a in alphabets for _ in range(150)]
    return texts + ["a <|endoftext|>b<|startoftext|> c", "x<|endoftext|>", " <|endoftext|> ", None, "x" * 5000, "zq" * 4000]


@pytest.mark.parametrize("path,by_word", [(WORD, True), (WORD, False), (BYTE, False)])
def test_ids_and_texts_are_the_librarys(path, by_word):
    enc = bpe.FragmentEncoder(path, by_word)
    assert enc.plain == by_word
    texts = nasty()
    for _ in range(2):  # the second time from what was remembered
        flat, size = enc.texts(pa.array(texts))
        want = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert size.tolist() == [len(w) for w in want]
        assert flat.tolist() == [i for w in want for i in w]
    assert [enc.decode(w) for w in want] == [enc.tokenizer.decode(w, skip_special_tokens=False) for w in want]


def test_small_table_gives_the_same(monkeypatch):
    enc = bpe.FragmentEncoder(WORD, True)
    enc.known = bpe.IdTable(enc.dtype, bits=4, ids=64)
    texts = nasty()
    flat, size = enc.texts(pa.array(texts))
    for i in range(0, len(texts), 7):  # slices that throw each other out
        part, n = enc.texts(pa.array(texts[i : i + 7]))
        assert n.tolist() == size[i : i + 7].tolist()
        assert part.tolist() == flat[size[:i].sum() : size[: i + 7].sum()].tolist()


def test_certain_cuts_are_those_no_token_spans():
    enc = bpe.FragmentEncoder(WORD, True)
    vocabulary = enc.tokenizer.get_vocab(with_added_tokens=False)
    joined = enc.boundaries.joined

    def spanned(pair, ends):
        for token in vocabulary:
            word = token.removesuffix("</w>") or token
            if word.endswith(pair) and word != token if ends else pair in (word if word == token else word[:-1]):
                return True
        return False

    for a, b, ends in (("q", "z", 0), ("t", "h", 0), ("x", "q", 256), ("n", "g", 256), ("v", "q", 0)):
        assert joined[ord(a), ord(b) + ends] == spanned(a + b, ends)
    assert 0.9 < (~joined).mean() < 1


def test_query_rows(spark, awkward):
    rows, df = awkward
    tok = Tokenizer.from_file(WORD)

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = []
    for d, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.round_trip_digests(df.repartition(3), WORD, by_word=True).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_whole_small_table(spark, small_documents):
    rows, df = small_documents
    tok = Tokenizer.from_file(WORD)
    want = {d: tok.encode(t or "", add_special_tokens=False).ids for d, t, _ in rows}
    encoded = bpe.encode(df, WORD, by_word=True)
    assert {r.doc_id: r.ids for r in encoded.collect()} == want
    texts = {r.doc_id: r.text for r in bpe.decode(encoded, WORD).collect()}
    assert texts == {d: tok.decode(i, skip_special_tokens=False) for d, i in want.items()}


def test_empty_table(spark, nothing):
    assert bpe.round_trip_digests(nothing, WORD, by_word=True).collect() == []


def test_clashing_names(spark):
    df = documents(spark, [(1, "Hello world")]).selectExpr("doc_id as `my id`", "text as `a.text`", "'x' as ids", "1 as id")
    got = bpe.encode(df, WORD, by_word=True, id_col="my id", text_col="a.text").first()
    assert got["my id"] == 1 and got.ids == Tokenizer.from_file(WORD).encode("Hello world", add_special_tokens=False).ids
