"""Personal data: patterns propose spans, checksums confirm them, nearby
words adjust the score.  DataFrame functions only.

Per kind, the leftmost non-overlapping matches of its pattern are proposed;
a match that fails its check (IP parts, Luhn, mod-97, digit counts) is
dropped without a retry.  The text between matches comes from splitting at
the same pattern, so a span's start is a running sum of lengths in code
points, and the ends of the parts on either side are the context.

The patterns are written for linear time on any text: possessive, and
started only where a run of their characters starts (or where the last match
ended), which matches exactly what the plain form matches.

Base kinds (email, ip, card, phone) stay whatever their score; added kinds
(iban, national_phone) need ``min_score``.

Defined results: a null text is empty and has no spans; repeated rows give
repeated results; a null id stays null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = "[A-Za-z0-9-]"
#: Characters of context on either side.
CONTEXT = 40


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: a cheap necessary condition on the whole text
    maybe: str
    score: float
    #: words nearby that add to or take from the score
    words: str
    raises: float = 0.25
    lowers_words: str = ""
    lowers: float = 0.0
    base: bool = True


#: In the order of the digests.
KINDS = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++", "@", 0.8,
         "email|e-mail|mail|contact|write"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", 0.6,
         "ip|address|host|server|client", lowers_words="version|release|section", lowers=0.3),
    Kind("card", r"[0-9](?:[ -]?+[0-9])++", "[0-9](?:[ -]?[0-9]){15}", 0.75, "card|visa|mastercard|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 0.7, "phone|tel|telephone|call|mobile|fax"),
    Kind("iban", "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", "[A-Z]{2}[0-9]{2} ?[A-Z0-9]", 0.75,
         "iban|account|bank|transfer|konto", base=False),
    Kind("national_phone", r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}", r"\([0-9]{3}\)", 0.35,
         "phone|tel|telephone|call|mobile|fax", base=False),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, 1).cast("int")
        twice = d * 2
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _mod97(iban: Column) -> Column:
    chars = F.split(F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4)), "")

    def add(rest: Column, c: Column) -> Column:
        return F.when(c == "", rest).when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise(
            (rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(chars, F.lit(0), add) == 1


def confirmed(kind: Column, found: Column, before: Column) -> Column:
    """The check of a proposed span."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    # a part of zeros only keeps its last zero for the value
    part = f"(?:{part}|0++)"
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", found.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
            .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(8, 15))
            .when(kind == "iban", _mod97(F.replace(found, F.lit(" "), F.lit(""))))
            .otherwise(~before.rlike(r"\+[0-9 ]*$")))


def _score(kind: Column, around: Column) -> Column:
    out = F.lit(0.0)
    for k in KINDS:
        near = F.when(around.rlike(f"(^|[^a-z])({k.words})([^a-z]|$)"), k.raises).otherwise(0.0)
        if k.lowers:
            near = near - F.when(around.rlike(f"(^|[^a-z])({k.lowers_words})([^a-z]|$)"), k.lowers).otherwise(0.0)
        out = F.when(kind == k.name, F.lit(k.score) + near).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def _proposal(no: int):
    return lambda z: F.struct(
        F.lit(no).alias("no"), z["found"].alias("found"), F.length(z["before"]).cast("bigint").alias("gap"),
        F.right(z["before"], F.lit(CONTEXT)).alias("before"), F.left(z["after"], F.lit(CONTEXT)).alias("after"))


def find_pii(docs: DataFrame, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans``, an array of (kind, start, end, score, found)
    by kind in the order of KINDS, then start; offsets in code points.

    Only documents' ids and proposed spans are shuffled, never texts.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
                       text.alias("text"))
    no_strings = F.array().cast("array<string>")
    for k in KINDS:
        maybe = F.contains("text", F.lit(k.maybe)) if k.maybe == "@" else F.col("text").rlike(k.maybe)
        rows = rows.withColumn(f"found_{k.name}", F.when(maybe, F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)))
                               .otherwise(no_strings))
    for k in KINDS:
        rows = rows.withColumn(f"parts_{k.name}", F.when(F.size(f"found_{k.name}") > 0, F.split("text", k.pattern, -1))
                               .otherwise(no_strings))
    proposed = []
    for no, k in enumerate(KINDS):
        found, parts = F.col(f"found_{k.name}"), F.col(f"parts_{k.name}")
        zipped = F.arrays_zip(found.alias("found"), F.slice(parts, F.lit(1), F.size(found)).alias("before"),
                              F.slice(parts, F.lit(2), F.size(found)).alias("after"))
        proposed.append(F.when(F.size(found) > 0, F.transform(zipped, _proposal(no))))
    empty = F.array().cast("array<struct<no:int,found:string,gap:bigint,before:string,after:string>>")
    each = rows.select("rid", "id", F.posexplode_outer(F.concat(*[F.coalesce(p, empty) for p in proposed]))
                       .alias("pos", "p")).select("rid", "id", "pos", "p.*")
    of_kind = Window.partitionBy("rid", "no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("found")).over(of_kind)
    kind = F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), F.col("no") + 1)
    each = (each.withColumn("end", end).withColumn("start", F.col("end") - F.length("found"))
            .withColumn("kind", F.when(F.col("no").isNotNull(), kind)))
    scored = (each.withColumn("ok", confirmed(F.col("kind"), F.col("found"), F.col("before")))
              .withColumn("score", _score(F.col("kind"), F.lower(F.concat("before", F.lit(" "), "after")))))
    keep = F.col("ok") & (F.col("kind").isin(*BASE) | (F.col("score") >= min_score))
    span = F.when(keep, F.struct("no", "start", "end", "score", "kind", "found"))
    spans = F.transform(F.sort_array(F.collect_list(span)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"),
        s["found"].alias("found")))
    return scored.groupBy("rid", "id").agg(spans.alias("spans")).select(F.col("id").alias(id_col), "spans")


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
