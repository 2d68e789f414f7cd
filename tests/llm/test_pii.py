"""Personal data against Python's re with the plain patterns."""

import random
import re

from awkward_tables import documents

from wareshift.llm.pii import BASE, KINDS, find_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(d) <= 15
    if kind == "iban":
        s = s.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    return True


def brute(text, kinds=BASE):
    return [(k, m.start(), m.end()) for k in kinds for m in re.finditer(PLAIN[k], text or "", re.ASCII)
            if valid(k, m.group())]


def found(df):
    return [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in find_pii(df).collect()]


CASES = [
    "a@b.c", "a@b", "x@y.z@w.v", "a@b.com_x@d.e.", "a@b.c..d@e.f", "@@a@b.c", "é@b.c ü a.b+c@d-e.f-g.h!", "a@-.-",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.000.0255.1", "1.2.3", "00.0.0.000", "9999999999.1.1.1", "1..2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111  1111 1111 1111", "4111111111111112", "6011000990139424000",
    "+1 (555) 123-4567", "+12345678", "+1234567", "+1+2 333 4444 55", "+1 ((((((", "+49 30 1234567890123456",
    "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000 bank", "DE89370400440532013001",
    "call (555) 123-4567 today", "nothing (555) 123-4567 here", "mail: q@r.st, ip 10.0.0.1, tel +44 20 7946 0958",
]


def test_cases(spark):
    rows = list(enumerate(CASES))
    got = dict(found(documents(spark, rows)))
    for i, text in rows:
        assert [s for s in got[i] if s[0] in BASE] == brute(text), text


def test_random_texts(spark):
    rnd = random.Random(6)
    bits = ["a", "1", "2", "55", "255", ".", "@", "+", "-", " ", "(", ")", "é", "4111111111111111", "b.c", "10.0.0.7",
            "+1 555 123 4567", "x@y.z"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 40)))) for i in range(1500)]
    got = dict(found(documents(spark, rows)))
    for i, text in rows:
        assert [s for s in got[i] if s[0] in BASE] == brute(text), text


def test_added_kinds_and_context(spark):
    rows = [(1, "IBAN GB82 WEST 1234 5698 7654 32 of the account"), (2, "code GB82 WEST 1234 5698 7654 33"),
            (3, "please call (555) 123-4567"), (4, "case (555) 123-4567"), (5, "tel +1 (555) 123-4567")]
    got = dict(found(documents(spark, rows)))
    assert [k for k, *_ in got[1]] == ["iban"] and got[2] == []
    assert [k for k, *_ in got[3]] == ["national_phone"] and got[4] == []
    assert [k for k, *_ in got[5]] == ["phone"]
    scores = {r.doc_id: {s.kind: s.score for s in r.spans} for r in find_pii(documents(spark, rows)).collect()}
    assert scores[1]["iban"] > next(k.score for k in KINDS if k.name == "iban")


def test_awkward_rows(awkward):
    rows, df = awkward
    assert sorted(found(df), key=str) == sorted([(d, brute(t)) for d, t, *_ in rows], key=str)


def test_empty_table(nothing):
    assert found(nothing) == []


def test_very_long_texts(spark):
    n = 100_000
    texts = ["a" * n, "1" * n, "1." * n, "a." * n + "@x", "x@" + "a." * n + "b", "+1" * n, "+1" + " " * n, "a@" * n,
             "x@y.z " * 3000, "A1" * n, "(" * n]
    got = dict(found(documents(spark, list(enumerate(texts)))))
    assert len(got) == len(texts)
    assert got[4] == [("email", 0, 2 + 2 * n + 1)]
    assert len(got[8]) == 3000 and got[8][-1] == ("email", 2999 * 6, 2999 * 6 + 5)


def test_small_table(small_documents):
    rows, df = small_documents
    got = {d: [s for s in spans if s[0] in BASE] for d, spans in found(df)}
    assert got == {d: brute(t) for d, t, _ in rows}
