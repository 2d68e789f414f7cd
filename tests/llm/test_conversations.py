"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from wareshift.llm import conversations as C
from wareshift.llm.role_grammar import CONVERSATION, RoleGrammar, RoleRepair

MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest(rows):
    """(cost, audit, roles) least over all edits, by a table over the
    regular expression's states."""

    def inserted(now):
        for _ in range(3):
            for s, (c, a, w) in list(now.items()):
                for t in "ua":
                    to = MOVES.get((s, t))
                    if to is not None and (to not in now or (c + 3, a + "I") < now[to][:2]):
                        now[to] = (c + 3, a + "I", w + t)
        return now

    now = {0: (0, "", "")}
    for row in rows:
        new = {}

        def offer(s, v):
            if s not in new or v[:2] < new[s][:2]:
                new[s] = v

        for s, (c, a, w) in inserted(now).items():
            offer(s, (c + 4, a + "D", w))
            if row != "-":
                more = 3 if row.isupper() else 0
                if (s, row.lower()) in MOVES:
                    offer(MOVES[s, row.lower()], (c + more, a + "K", w + row.lower()))
                for t in "ua":
                    if (s, t) in MOVES:
                        offer(MOVES[s, t], (c + more + 3, a + "R", w + t))
        now = new
    now = inserted(now)
    return min(now[s] for s in (0, 3) if s in now)


def read(repair, rows):
    reading = repair.begin()
    for r in rows:
        reading.row(r)
    return reading.finish()


def test_all_short_conversations():
    repair = RoleRepair()
    for n in range(5):
        for rows in itertools.product("suaxSUAX-", repeat=n):
            assert read(repair, rows) == cheapest(rows), rows


def test_long_conversations_take_few_steps():
    repair = RoleRepair()
    rnd = random.Random(4)
    for _ in range(150):
        rows = [rnd.choice("suaxSUAX--uauaua") for _ in range(rnd.choice([10, 60, 400]))]
        assert read(repair, rows) == cheapest(rows)
    assert len(repair.fronts) < 500


def test_tables():
    grammar = RoleGrammar()
    assert grammar.terminals == ["a", "s", "u"]
    for n in range(7):
        for word in itertools.product("sua", repeat=n):
            stacks = [grammar.root]
            for c in word:
                stacks = [x for s in stacks for x in grammar.shift(s, c)]
            assert any(map(grammar.accepts, stacks)) == bool(re.fullmatch("(s?(ua)+)?", "".join(word)))
    with pytest.raises(ValueError, match="not bounded"):
        RoleGrammar((("C", ""), ("C", "uCa")))
    with pytest.raises(ValueError, match="equal tops"):
        RoleGrammar((("C", "uBs"), ("C", "sBu"), ("B", "a")))
    assert RoleGrammar(CONVERSATION).terminals == grammar.terminals


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        elif k == 2:
            text = re.sub("[.!?]", "", text)
        elif k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def brute(rows, damage=True):
    """The contract's rows, in plain Python; ties in turn by role (a test
    with such ties keeps their texts equal)."""
    want = []
    kept = damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in dict.fromkeys(r[0] for r in rows):
        mine = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        turns = [r[1] for r in mine if r[1] is not None]
        counts = {"b": 0, "d": 0, "t": 0}
        seen, letters = set(), []
        for _, _, role, text in mine:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not marks:
                fault = "b"
            elif (role, text) in seen:
                fault = "d"
            else:
                fault = "" if marks[-1] in ".!?" else "t"
            if fault:
                counts[fault] += 1
            seen.add((role, text))
            letters.append("-" if fault in ("b", "d") else initial.upper() if fault == "t" else initial)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, roles = cheapest(letters)
        at, lines, left = 0, [], iter(roles)
        for edit in audit:
            if edit == "I":
                lines.append(("user" if next(left) == "u" else "assistant") + ":")
                continue
            _, _, role, text = mine[at]
            at += 1
            if edit != "D":
                new = next(left)
                lines.append(f"{role if edit == 'K' else 'user' if new == 'u' else 'assistant'}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        want.append((conv, gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(want, key=str)


CLASHING = "text string, conv_id bigint, role string, turn bigint, c int, kind string, sub int, h1 int, known string, `my col` int"


def frame(spark, rows):
    return spark.createDataFrame([(x, c, r, t, 1, "k", 2, 3, "z", 4) for c, t, r, x in rows], CLASHING)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def awkward_rows():
    rnd = random.Random(9)
    texts = ["Yes.", "No", "", " \n\t", None, "Why?", "It is so!  ", "a\u0085", ". ", " ", "é.", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "umpire", "ärger"]
    rows = []
    for conv in range(120):
        for turn in range(rnd.choice([0, 1, 2, 5, 9])):
            rows.append((conv, turn * rnd.choice([1, 1, 2]) + conv % 3, rnd.choice(roles), rnd.choice(texts)))
    rows = [r for i, r in enumerate(rows) if (r[0], r[1]) not in {(x[0], x[1]) for x in rows[:i]}]
    rows += [(None, 1, "user", "No conversation."), (None, 2, "assistant", "None.")]
    rows += [(500, None, "user", "Hm."), (500, 3, "assistant", "Ah."), (501, None, None, None), (502, -4, "user", "a."), (502, 9, "user", "a.")]
    rows += [(503, 1, "user", "Same."), (503, 1, "user", "Same."), (503, 1, "assistant", "Same."), (503, 1, "assistant", "Same.")]
    rows += [(504, -(1 << 63), "user", "a."), (504, (1 << 63) - 1, "user", "b.")]
    return rows


def test_report_equals_brute_force(spark):
    rows = awkward_rows()
    want = [(*w[:1], min(w[1], (1 << 63) - 1), *w[2:]) for w in brute(rows)]
    df = C.repair_report(C.damage(frame(spark, rows).repartition(5)))
    assert got(df) == sorted(want, key=str)


def test_without_damage(spark):
    rows = awkward_rows()
    want = [(*w[:1], min(w[1], (1 << 63) - 1), *w[2:]) for w in brute(rows, damage=False)]
    assert got(C.repair_report(frame(spark, rows).repartition(5))) == sorted(want, key=str)


def test_whole_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert got(C.repair_report(C.damage(df))) == brute(rows)


def test_dropped_conversations_stay(spark):
    gone = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = [(c, 0, "user", "Hi.") for c in gone]
    empty = hashlib.sha256(b"").hexdigest()
    assert got(C.repair_report(C.damage(frame(spark, rows)))) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c in gone), key=str)


def test_one_hot_conversation(spark):
    rnd = random.Random(2)
    rows = [(7, t, rnd.choice(["user", "assistant", "system"]), f"{rnd.choice('abc')}{t % 900}.") for t in range(6000)]
    rows += [(c, t, "user", "Hi.") for c in range(100, 130) for t in range(3)]
    assert got(C.repair_report(C.damage(frame(spark, rows).repartition(6)))) == brute(rows)


def test_repaired_turns(spark):
    rows = awkward_rows()
    report = {r.conv_id: r.repaired_sha256 for r in C.repair_report(C.damage(frame(spark, rows))).collect()}
    lines = {}
    for r in C.repaired_turns(C.damage(frame(spark, rows))).orderBy("conv_id", "position").collect():
        mine = lines.setdefault(r.conv_id, [])
        assert r.position == len(mine) + 1 and (r.edit != "I" or (r.text == "" and r.turn is None))
        mine.append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in report} == report
    assert all(re.fullmatch("s?(ua)+", "".join(x[0] for x in mine)) for mine in lines.values())


def test_empty_table(spark):
    assert C.repair_report(C.damage(frame(spark, []))).collect() == []
    assert C.repaired_turns(frame(spark, [])).collect() == []
