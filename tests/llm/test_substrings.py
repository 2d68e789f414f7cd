"""Substring dedup against a dictionary of all windows."""

import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from awkward_tables import documents

from wareshift.llm import substrings as S
from wareshift.llm.text import Words


def brute(rows, window):
    words = [(t or "").encode().split() for _, t, *_ in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, *_), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((doc, len(w), sum(gone), kept))
    return sorted(out, key=str)


def run(df, **options):
    return sorted(((r[0], r.n_words, r.n_removed, r.kept) for r in S.remove_repeats(df, **options).collect()), key=str)


@pytest.mark.parametrize("block", [4_000_000, 20])
def test_awkward_rows(awkward, block):
    rows, df = awkward
    assert run(df, window=35, seed_block=block) == brute(rows, 35)


def test_empty_table(nothing):
    assert run(nothing) == []


def test_small_table(small_documents):
    rows, df = small_documents
    assert run(df) == brute(rows, 35)


def test_periodic_and_nested_passages(spark):
    rnd = random.Random(3)
    pool = [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 40))) for _ in range(12)]
    rows = [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 5)))) for i in range(60)]
    rows += [(100, "a " * 200), (101, "a " * 150), (102, "a b " * 60)]
    assert run(documents(spark, rows), window=9, seed=4) == brute(rows, 9)


def test_several_automata(monkeypatch):
    monkeypatch.setattr(S, "AUTOMATON_WORDS", 7)
    words = Words(pa.array(["q a b c d e f g h", "a b c d x e f g h", ""]))
    passages = [(1, 5), (5, 9)]
    got = S.covered(words, passages)
    want = [False] + [True] * 8 + [True] * 4 + [False] + [True] * 4
    assert got.tolist() == want


def test_a_passage_longer_than_an_automaton(monkeypatch):
    """Cut into overlapping parts: no alphabet exceeds the limit, the coverage is that of the whole."""
    monkeypatch.setattr(S, "AUTOMATON_WORDS", 20)
    sizes, whole = [], S.covered
    monkeypatch.setattr(S, "covered", lambda words, passages: sizes.extend(t - f for f, t in passages) or whole(words, passages))
    texts = ["a0 " + " ".join(f"w{i}" for i in range(n)) + " z0 " + " ".join(f"w{i}" for i in range(30, 38)) for n in (200, 200, 63)]
    words = Words(pa.array(texts))
    p = S.Pieces(words, 9, 4)
    grams = [w[i : i + 9] for w in (t.split() for t in texts) for i in range(len(w) - 8)]
    seen = collections.Counter(map(tuple, grams))
    d1, d2 = p.digests(np.arange(len(p.first)))
    flat = sum((t.split() for t in texts), [])
    mask = [sum(1 << i for i in range(c) if seen[tuple(flat[f + i : f + i + 9])] > 1) for f, c in zip(p.first.tolist(), p.count.tolist())]
    got = S._shard_cover(words, 9, 4, d1, d2, np.array(mask, np.int64))
    want = np.zeros(len(flat), bool)
    for f in np.flatnonzero(words.whole(9)).tolist():
        if seen[tuple(flat[f : f + 9])] > 1:
            want[f : f + 9] = True
    assert got.tolist() == want.tolist() and max(sizes) <= 20


def test_pieces_partition_the_windows():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("abcd") for _ in range(n)) for n in (0, 3, 9, 10, 200)]
    words = Words(pa.array(texts))
    p = S.Pieces(words, 9, 4)
    starts = sorted(itertools.chain.from_iterable(range(f, f + c) for f, c in zip(p.first.tolist(), p.count.tolist())))
    assert starts == np.flatnonzero(words.whole(9)).tolist()
    assert ((p.offset >= p.count - 1) & (p.offset <= 5)).all()
