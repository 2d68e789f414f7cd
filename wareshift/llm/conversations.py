"""Conversation structure repair.

Turns are put in order, judged (blank, duplicate, truncated), and each
conversation gets its cheapest repair by the generalised LR parser of
``role_grammar``: rows are kept, reroled or deleted and turns inserted until
the roles follow ``(system? (user assistant)+)?``.

How the work is dealt: one pass over the rows finds each (conversation,
role, text)'s first turn by an aggregate that combines before its shuffle.
The rows then go once to their conversation's task, sorted there outside
memory, first without texts (the parser reads them), then with texts (the
repaired rows or their digest stream by).  A conversation costs the task four
bytes a row plus its audit, which the result holds as one value anyway; no
texts are held.  The order of rows and one running SHA-256 are what a
conversation's result is made of, so a conversation is not cut up.

Defined results: a null role, text or id in the damage key reads as one
space; a null conversation id is a conversation of its own; null turns come
first.  Rows of equal turn are ordered by role, then by the 128-bit
fingerprint of role and text, equal rows side by side.  An empty role has no
legal initial.  Blank and duplicate rows must go, so a row that repeats a
blank one is blank.  A conversation whose rows were all dropped has zeros, an
empty audit and the hash of the empty text.  ``gaps`` stops at the largest
long.  An empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.llm.role_grammar import ROLES, RoleRepair

_MARK = r"[^\x20\x09-\x0D]"
_CLOSED = r"[.!?][\x20\x09-\x0D]*\z"
_LEGAL = {"su", "ua", "au"}
_TOP = (1 << 63) - 1
#: Rows that one result batch holds.
OUT_ROWS = 2000


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: by ``crc32(conv_id:turn) % 20`` a
    row is dropped (0: no copies), emptied (1), loses ``[.!?]`` (2), is
    doubled (3) or becomes the user's (4)."""
    key = F.concat(_spaced(F.col("conv_id").cast("string")), F.lit(":"), _spaced(F.col("turn").cast("string")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = _spaced(F.col("role")), _spaced(F.col("text"))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _spaced(c: Column) -> Column:
    return F.coalesce(c, F.lit(" "))


def _events(turns: DataFrame) -> DataFrame:
    """Everything a conversation's task reads, in one sortable shape: kind 0
    rows without text (sub 0: the first turn of a role and text; sub 1: a
    row), then kind 1 rows with text."""
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    text = _spaced(F.col("text"))
    rows = turns.select(
        F.col("conv_id").alias("c"), F.col("turn").isNotNull().cast("int").alias("known"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("t"), _spaced(F.col("role")).alias("role"),
        text.alias("text"), copies.cast("int").alias("copies"))
    rows = rows.select("*", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"))
    firsts = rows.where("copies > 0").groupBy("c", "role", "h1", "h2").agg(
        F.min("known").alias("known"), F.min(F.when(F.col("known") == 1, F.col("t"))).alias("t"))
    firsts = firsts.select(
        "c", F.lit(0).alias("kind"), "known", F.when(F.col("known") == 1, F.col("t")).otherwise(0).alias("t"), "role",
        "h1", "h2", F.lit(0).alias("sub"), F.lit(1).alias("copies"), F.lit("").alias("fault"),
        F.lit(None).cast("string").alias("text"))
    fault = F.when(~F.col("text").rlike(_MARK), "b").when(~F.col("text").rlike(_CLOSED), "t").otherwise("")
    both = rows.withColumn("kind", F.explode(F.when(F.col("copies") > 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    seen = both.select(
        "c", "kind", "known", "t", "role", "h1", "h2", F.lit(1).alias("sub"), "copies",
        F.when(F.col("kind") == 0, fault).otherwise("").alias("fault"),
        F.when(F.col("kind") == 1, F.col("text")).alias("text"))
    order = ["c", "kind", "known", "t", "role", "h1", "h2", "sub"]
    return firsts.unionByName(seen).repartition("c").sortWithinPartitions(*order)


class _Conversation:
    """The running state of one conversation's rows."""

    def __init__(self, repair: RoleRepair, conv_id):
        self.id = conv_id
        self.reading = repair.begin()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last_turn = None
        self.turns = 0
        self.before = ""
        self.first = None  # (turn, fingerprint) of the row that is not a duplicate
        self.out = None

    def judge(self, known: int, turn: int, role: str, print_: tuple, copies: int, fault: str) -> None:
        if copies and known and turn != self.last_turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        initial = role[:1]
        for _ in range(copies):
            if self.reading.path and self.before + initial not in _LEGAL:
                self.illegal += 1
            self.before = initial
            fresh = self.first == (known, turn, print_)
            self.first = None if fresh else self.first
            if fault == "b":
                self.blank += 1
                letter = "-"
            elif not fresh:
                self.duplicate += 1
                letter = "-"
            else:
                letter = initial if initial in ("s", "u", "a") else "x"
                if fault == "t":
                    self.truncated += 1
                    letter = letter.upper()
            self.reading.row(letter)

    def gaps(self) -> int:
        return min(self.high - self.low + 1 - self.turns, _TOP) if self.turns else 0

    def repaired(self) -> "_Repaired":
        if self.out is None:
            self.out = _Repaired(*self.reading.finish())
        return self.out


class _Repaired:
    """Walks the audit as the rows with texts come by."""

    def __init__(self, cost: int, audit: str, roles: str):
        self.cost, self.audit, self.roles = cost, audit, roles
        self.at = self.kept = 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield "I", ROLES[self.roles[self.kept]], ""
            self.at += 1
            self.kept += 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns before and at the next row; a
        deleted row too, with edit D."""
        yield from self.inserted()
        edit = self.audit[self.at]
        yield edit, ROLES[self.roles[self.kept]] if edit == "R" else role, text
        self.at += 1
        self.kept += edit != "D"


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def _conversations(batches: Iterator[pa.RecordBatch], repair: RoleRepair, start, row, end) -> Iterator:
    """Drive ``start(conversation)``, ``row(conversation, turn, edits)`` and
    ``end(conversation, edits)`` over the sorted events, yielding what the
    last two give."""
    now = None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for c, kind, known, turn, role, h1, h2, sub, copies, fault, text in zip(*columns):
            if now is None or not _same(now.id, c):
                if now is not None:
                    yield from end(now, now.repaired().inserted())
                now = _Conversation(repair, c)
                start(now)
            if kind == 0 and sub == 0:
                now.first = (known, turn, (h1, h2))
            elif kind == 0:
                now.judge(known, turn, role, (h1, h2), copies, fault)
            else:
                for _ in range(copies):
                    yield from row(now, turn if known else None, now.repaired().row(role, text))
    if now is not None:
        yield from end(now, now.repaired().inserted())


def _mapped(turns: DataFrame, fields: list[T.StructField], kinds: list[pa.DataType], drive) -> DataFrame:
    schema = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = RoleRepair()
        id_kind = None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal id_kind
            for batch in batches:
                id_kind = batch.schema.field(0).type
                yield batch

        def flush(held: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(list(c), k) for c, k in zip(zip(*held), [id_kind, *kinds])]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        held: list[tuple] = []
        size = 0
        for result in drive(seen(), repair):
            held.append(result)
            size += sum(len(v) for v in result if isinstance(v, str))
            if len(held) >= OUT_ROWS or size >= 8_000_000:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return _events(turns).mapInArrow(run, schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, position (from 1), edit (K, R, I), turn (null: inserted),
    role, text of the repaired conversations.

    ``turns``: conv_id, turn, role, text, and copies where a row stands for
    several (0: it only names its conversation)."""

    def drive(batches, repair):
        def start(conv):
            conv.position = 0

        def placed(conv, turn, edits):
            for edit, role, text in edits:
                if edit != "D":
                    conv.position += 1
                    yield conv.id, conv.position, edit, None if edit == "I" else turn, role, text

        return _conversations(batches, repair, start, placed, lambda conv, edits: placed(conv, None, edits))

    fields = [T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()),
              T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    return _mapped(turns, fields, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()], drive)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal,
    cost, audit (the edits' letters in order) and repaired_sha256 (of the
    repaired ``role:text`` lines)."""

    def drive(batches, repair):
        def start(conv):
            conv.digest = hashlib.sha256()
            conv.lines = 0

        def add(conv, turn, edits):
            for edit, role, text in edits:
                if edit != "D":
                    conv.digest.update(f"{chr(10) if conv.lines else ''}{role}:{text}".encode())
                    conv.lines += 1
            return ()

        def end(conv, edits):
            add(conv, None, edits)
            found = conv.repaired()
            yield (conv.id, conv.gaps(), conv.blank, conv.duplicate, conv.truncated, conv.illegal, found.cost,
                   found.audit, conv.digest.hexdigest())

        return _conversations(batches, repair, start, add, end)

    fields = [T.StructField(n, T.LongType()) for n in _COUNTS]
    fields += [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    return _mapped(turns, fields, [pa.int64()] * len(_COUNTS) + [pa.string(), pa.string()], drive)
