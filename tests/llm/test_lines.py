"""Line dedup against all pairs of lines."""

import random

import pytest
from awkward_tables import documents
from pyspark.sql import functions as F

from wareshift.llm.lines import allowed, edit_distance, near_lines, near_lines_by_length, removed_lines, without_lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def change(rnd, text, n, letters="abcé "):
    c = list(text)
    for _ in range(n):
        i = rnd.randrange(len(c) + 1)
        kind = rnd.randrange(3)
        if kind == 0 or i == len(c):
            c.insert(i, rnd.choice(letters))
        elif kind == 1:
            c[i] = rnd.choice(letters)
        else:
            del c[i]
    return "".join(c)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_edit_distance(spark, distance):
    rnd = random.Random(distance)
    pairs = []
    for _ in range(1500):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randrange(0, 14)))
        b = change(rnd, a, rnd.randrange(0, 5), "abé")
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        if len(a) - len(b) <= distance:
            pairs.append((a, b, edits(a, b)))
    chars = lambda c: F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))
    df = spark.createDataFrame(pairs, "a string, b string, d int")
    for r in df.withColumn("e", edit_distance(chars("a"), chars("b"), distance)).collect():
        assert r.e == r.d if r.d <= distance else r.e > distance, r


@pytest.mark.parametrize("distance", [1, 2])
def test_every_near_pair_is_found(spark, distance):
    rnd = random.Random(distance)
    base = ["".join(rnd.choice("abcé ") for _ in range(rnd.randrange(4, 25))) for _ in range(40)]
    lines = sorted({change(rnd, rnd.choice(base), rnd.randrange(0, 4)) for _ in range(500)} - {""})
    lines = [x for x in lines if len(x) > distance]
    df = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "lid bigint, line string, chars int")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in near_lines(df, distance).collect()}
    want = {(i, j) for j in range(len(lines)) for i in range(j)
            if abs(len(lines[i]) - len(lines[j])) <= distance and edits(lines[i], lines[j]) <= distance}
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_a_crowd_meets_by_finer_keys(spark, monkeypatch, seed):
    """Whatever a crowd is, the same pairs are found; those of lines changed
    in several neighbouring letters are no candidates."""
    import wareshift.llm.lines as L

    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcé ") for _ in range(n)) for n in (11, 13, 31, 36, 47, 60)]
    lines = sorted({change(rnd, rnd.choice(base), rnd.randrange(0, 4)) for _ in range(400)})
    df = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "lid bigint, line string, chars int")
    want = {(i, j) for j in range(len(lines)) for i in range(j)
            if abs(len(lines[i]) - len(lines[j])) <= 2 and edits(lines[i], lines[j]) <= 2}
    monkeypatch.setattr(L, "CROWD", 0)
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in near_lines(df, 2).collect()} == want and len(want) > 500
    monkeypatch.undo()
    line = "".join(rnd.choice("abcdefgh ") for _ in range(240))
    many = [line[:i] + "xyz" + line[i:] for i in range(0, 240)]
    df = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(many)], "lid bigint, line string, chars int")
    assert L.candidate_pairs(df, 2).count() < 240 * 239 / 2 / 2


@pytest.mark.parametrize("close", [0, 3])
def test_a_crowd_is_linked(spark, monkeypatch, close):
    """The links of a crowd are pairs within two edits, and link what all such pairs link."""
    import wareshift.llm.lines as L

    rnd = random.Random(close)
    base = ["".join(rnd.choice("abcé ") for _ in range(n)) for n in (1, 2, 3, 4, 5, 9, 20, 41)]
    lines = sorted({change(rnd, rnd.choice(base), rnd.randrange(0, 5)) for _ in range(300)} - {""})
    df = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "lid bigint, line string, chars int")
    want = {(i, j) for j in range(len(lines)) for i in range(j) if edits(lines[i], lines[j]) <= 2}
    monkeypatch.setattr(L, "CLOSE", close)
    every = [(r.a, r.b) for r in L.crowd_pairs(df).collect()]
    assert {(min(x), max(x)) for x in every} == want and all(len(lines[a]) <= len(lines[b]) for a, b in every)
    links = [(r.a, r.b) for r in L.crowd_pairs(df, linked=True).collect()]
    assert {(min(x), max(x)) for x in links} <= want and all(len(lines[a]) <= len(lines[b]) for a, b in links)

    def groups(pairs):
        up = list(range(len(lines)))
        for _ in lines:
            for a, b in pairs:
                up[a] = up[b] = min(up[a], up[b])
        return up

    assert groups(links) == groups(want)


def test_few_candidates_of_a_large_crowd(spark):
    """Copies of a line with some letters put in: pairs would grow with the
    square, 20,000 and 320,000 here, and so would those of equal pieces."""
    import wareshift.llm.lines as L

    rnd = random.Random(5)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(300))

    def found(n):
        lines = sorted({line[:i] + "".join(rnd.choice("mnopqrst") for _ in range(4)) + line[i:]
                        for i in (rnd.randrange(300) for _ in range(n))})
        df = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "lid bigint, line string, chars int")
        return L.candidate_pairs(df, 2).count()

    assert found(200) < 1000 and found(800) < 4000


def test_a_template_is_linked_by_few_pairs(spark, monkeypatch):
    """Lines that are all near each other need no pairs but those to the first."""
    import wareshift.llm.lines as L

    monkeypatch.setattr(L, "CLOSE", 16)
    line = "a template of more than thirty characters, item "
    lines = [(i, f"{line}{chr(0x4E00 + i // 30)}{chr(0x4E00 + i % 30)}", len(line) + 2) for i in range(600)]
    df = spark.createDataFrame(lines, "lid bigint, line string, chars int")
    assert L.crowd_pairs(df, linked=True).count() < 5 * 600
    docs = documents(spark, [(i, x) for i, x, _ in lines])
    assert [r[2] for r in run(docs)].count(1) == 599


def brute(rows, distance, near_chars, percent=None):
    each = [(d is None, d or 0, p, i, line) for i, (d, t, *_) in enumerate(rows) if t is not None
            for p, line in enumerate(t.split("\n"))]
    texts = sorted({x[4] for x in each} - {""})
    up = {t: t for t in texts}

    def find(t):
        while up[t] != t:
            t = up[t]
        return t

    for j, b in enumerate(texts):
        for a in texts[:j]:
            n = min(len(a), len(b))
            most = (distance if n >= near_chars else 0) if percent is None else allowed(n, percent, distance, near_chars)
            if most and abs(len(a) - len(b)) <= most and edits(a, b) <= most:
                up[find(b)] = find(a)
    first = {}
    for x in sorted(each):
        if x[4]:
            first.setdefault(find(x[4]), x)
    out = []
    for i, (d, t, *_) in enumerate(rows):
        mine = [x for x in each if x[3] == i]
        gone = [x[2] for x in mine if x[4] and first[find(x[4])] != x]
        near = sum(bool(x[4]) and first[find(x[4])][4] != x[4] for x in mine)
        out.append((d, len(mine), len(gone), near, gone))
    return sorted(out, key=str)


def run(df, **options):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.n_near, r.removed) for r in removed_lines(df, **options).collect()),
                  key=str)


def test_documents(spark):
    rnd = random.Random(9)
    pool = ["".join(rnd.choice("abcé ") for _ in range(n)) for n in (0, 1, 5, 12, 20, 35, 60)]
    rows = [(i, "\n".join(change(rnd, rnd.choice(pool), rnd.choice([0, 0, 1, 2, 5])) for _ in range(rnd.randrange(1, 6))))
            for i in range(60)]
    assert run(documents(spark, rows), distance=2, near_chars=10) == brute(rows, 2, 10)


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_by_length(spark, seed):
    lines = length_lines(seed)
    rnd = random.Random(seed)
    rnd.shuffle(lines)
    rows = [(i, "\n".join(lines[4 * i : 4 * i + 4] + [""])) for i in range(len(lines) // 4)]
    assert run(documents(spark, rows), percent=5) == brute(rows, 2, 30, 5)


def test_beyond_the_small_sides(spark, monkeypatch):
    """The joins by shuffle give what the broadcasts give."""
    import wareshift.llm.lines as L

    rnd = random.Random(3)
    pool = ["".join(rnd.choice("abcé ") for _ in range(n)) for n in (0, 1, 12, 35, 60)]
    rows = [(i, "\n".join(change(rnd, rnd.choice(pool), rnd.choice([0, 0, 1, 2])) for _ in range(4))) for i in range(40)]
    monkeypatch.setattr(L, "SMALL_ROWS", 0)
    assert run(documents(spark, rows), distance=2, near_chars=10) == brute(rows, 2, 10)


def test_awkward_rows(awkward):
    rows, df = awkward
    got = run(df)
    want = brute([(d, t) for d, t, *_ in rows], 2, 30)
    # rows that repeat an id and text can swap
    assert got == want


def test_empty_table_and_long_lines(spark, nothing):
    assert run(nothing) == []
    rows = [(1, "ab" * 20_000), (2, "ab" * 20_000 + "c"), (3, "ba" * 20_000)]
    assert [r[2] for r in run(documents(spark, rows))] == [0, 1, 1]


def test_text_without_lines(spark):
    df = spark.createDataFrame([("a\nb\n\nc", [1, 3])], "t string, r array<int>")
    assert df.select(without_lines(F.col("t"), F.col("r")).alias("x")).first().x == "a\n"


def length_lines(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcé ") for _ in range(n)) for n in [*range(18, 64, 3), 79, 80, 81, 99, 100, 119, 120, 338, 342, 700]]
    out = set()
    for x in base:
        k = max(len(x) // 20, 2)
        for n in (0, 1, k - 1, k, k + 1):
            out.add(change(rnd, x, n))
            out.add(x[: len(x) - n] + "a" * n)
            # edits dealt evenly over the line leave the shortest whole parts
            at = {(2 * i + 1) * len(x) // (2 * n) for i in range(n)} if n else set()
            out.add("".join("" if i in at else c for i, c in enumerate(x)))
            out.add("".join("z" + c if i in at else c for i, c in enumerate(x)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_pairs_by_length(spark, seed):
    """5 % of the shorter line, two edits at least from 30 characters on."""
    lines = length_lines(seed)
    df = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "lid bigint, line string, chars int")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in near_lines_by_length(df, 5, 2, 30).collect()}
    want = set()
    for j, b in enumerate(lines):
        for i, a in enumerate(lines[:j]):
            n = min(len(a), len(b))
            most = max(n // 20, 2) if n >= 30 else n // 20
            assert allowed(n, 5, 2, 30) == most
            if most and abs(len(a) - len(b)) <= most and edits(a, b) <= most:
                want.add((i, j))
    assert got == want and len(want) > 200


def test_long_lines_six_edits_apart(spark):
    rnd = random.Random(7)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(338))
    near = "".join("z" + c if i % 56 == 50 else c for i, c in enumerate(line))
    short = "a line of 25 characters.."
    df = documents(spark, [(1, line), (2, near), (3, short), (4, short.replace("25", "26"))])
    assert edits(line, near) == 6
    assert [r[2] for r in run(df)] == [0, 0, 0, 0]
    assert [r[2] for r in run(df, percent=5)] == [0, 1, 0, 1]
