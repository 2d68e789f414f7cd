"""Token ids: exact round trip of the blocks, ids against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from awkward_tables import documents

from wareshift.llm import token_ids as T

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 1000, 4097])
def test_pack_round_trip(n):
    r = np.random.default_rng(n)
    top = r.choice([1 << 8, 1 << 16, 1 << 24, 1 << 32], n)
    ranks = (r.random(n) * top).astype(np.uint32)
    control, data = T.pack(ranks)
    assert len(control) == -(-n // 4)
    assert len(data) == sum(max(1, -(-int(x).bit_length() // 8)) for x in ranks)
    assert np.array_equal(T.unpack(control, data, n), ranks)


def test_boundaries():
    ranks = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], np.uint32)
    assert np.array_equal(T.unpack(*T.pack(ranks), len(ranks)), ranks)


def test_words_give_the_whole_texts_ids():
    enc = T.encoder(PATH, True)
    assert enc.plain
    rnd = random.Random(1)
    alphabets = ["abc 's 't ", "the And \n\t'll", "日本語한é🙂 x́", "A Σσς 12½", "<|endoftext|> x", "\x1c\x85 a\x0b\x0c　",
                 "ÀÉß×÷ÿ a1", "".join(chr(c) for c in range(33, 0x2100, 5)) + " "]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.choice([0, 1, 2, 5, 20, 100]))) for a in alphabets for _ in range(300)]
    texts += ["a <|endoftext|>b<|startoftext|> c", "x<|endoftext|>", " <|endoftext|> "]
    flat, size = enc.texts(pa.array(texts))
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert size.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def library_rows(rows, end):
    tok = T.encoder(PATH, True).tokenizer
    ids = [(d, tok.encode(t or "", add_special_tokens=False).ids + [end]) for d, t, *_ in rows]
    key = lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(np.array(x[1], "<u4").tobytes()))
    out, start = [], 0
    for d, i in sorted(ids, key=key):
        out.append((d, start, len(i), zlib.crc32(np.array(i, "<u4").tobytes()), np.array(i, "<u4").tobytes()))
        start += len(i)
    return out


@pytest.mark.parametrize("block", [262_144, 50])
def test_round_trip_through_files(spark, awkward, tmp, monkeypatch, block):
    rows, df = awkward
    monkeypatch.setattr(T, "BLOCK_IDS", block)
    T.write_token_ids(df.repartition(5), f"{tmp}/ids", PATH, end_id=2, by_word=True)
    got = T.read_token_ids(spark, f"{tmp}/ids", with_ids=True)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got.collect()]
    assert sorted(got, key=lambda r: r[1]) == library_rows(rows, 2)
    ranks = spark.read.parquet(f"{tmp}/ids/ranks").first()[0]
    assert len(set(ranks)) == len(ranks)


def test_whole_texts_of_any_tokenizer(spark, tmp):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "Hello  world"), (2, ""), (3, None), (4, "é \n x")]
    T.write_token_ids(documents(spark, rows), f"{tmp}/ids", path, end_id=50256)
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in T.read_token_ids(spark, f"{tmp}/ids", True).collect()}
    tok = T.encoder(path, False).tokenizer
    assert got == {d: tok.encode(t or "", add_special_tokens=False).ids + [50256] for d, t in rows}


def test_empty_table(spark, nothing, tmp):
    T.write_token_ids(nothing, f"{tmp}/ids", PATH, end_id=2, by_word=True)
    assert T.read_token_ids(spark, f"{tmp}/ids").collect() == []
