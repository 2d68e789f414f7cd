"""Line dedup: segment-partition edit join.  DataFrame functions only.

Of all lines of the corpus that are equal, or linked through lines within
``distance`` edits of each other, the first occurrence (smallest document id,
then line number) stays; the others are removed.  Empty lines always stay;
lines below ``near_chars`` characters are compared for equality only.

Edit join over the distinct lines: a line is cut into ``distance + 1``
segments.  If two lines are within the distance, one of the segments of the
shorter occurs unchanged in the longer, shifted by no more than the edits on
either side allow.  So each line is entered under (length, segment number,
segment), and looks up, for each length from its own down to ``distance``
less, the few substrings that can match there (where that is its own segment
at its own place, the entries meet each other).  Candidates are verified by
a banded bit-parallel edit distance: the cells within ``distance`` of the
diagonal are one small bit vector of vertical differences, moved one column
at a time by integer operations.

Lines cross one shuffle with their texts, where they become distinct; what
is joined after that are pairs of fingerprints.  Texts are read again for
the lines of candidate pairs only.  Small sides (at most ``SMALL_ROWS``
rows, counted) are broadcast, larger ones joined by a shuffle that splits
hot keys.

Many lines can share a segment and few of them be near.  Where a key has
more than ``CROWD`` entries (and the distance is 2), its lines meet by finer
keys instead, which are halved until few lines share one, or all that do are
within the distance and linked to the first (see :func:`crowd_pairs`).

With ``percent`` the edits allowed grow with the shorter line's length (see
:func:`allowed`).  Too many for a lookup per shift, so each line is entered
under its ``edits + 1`` segments' first characters, for the lengths and places
where the longer line can have them, and looks up all its character grams.

Defined results: a null text has no lines, an empty text one empty line;
repeated rows are documents of their own (their lines are repeats); null ids
come last in the order of occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareshift.llm.components import components
from wareshift.llm.stage import written
from wareshift.operators.joins import lookup_join


#: Rows (of a few numbers each) up to which a counted side is broadcast.
SMALL_ROWS = 400_000

#: Entries of a key from which on its lines meet by finer keys instead; and
#: rows of a finer key from which on these are halved.
CROWD = 16
CLOSE = 128

#: Pieces of a line for the comparison of two lines.
PIECES = 12


def _small_or_split(df: DataFrame, side: DataFrame, keys: list[str], side_keys: list[str], how: str) -> DataFrame:
    """Join with a written side that holds each key once: broadcast if it is
    small, else with hot keys of ``df`` split."""
    if side.count() <= SMALL_ROWS:
        return lookup_join(df, F.broadcast(side), keys, side_keys, how, split_hot_keys=False)
    return lookup_join(df, side, keys, side_keys, how)


def _places(distance: int) -> tuple[list, list]:
    """(gap, segment, shift) of the entries, and of the lookups: in a line
    that is ``gap`` longer the segment starts ``shift`` further right, as far
    as the edits left of it (as many as segments there) and right of it
    allow."""
    entries = [(0, i, 0) for i in range(distance + 1)]
    lookups = [(gap, i, shift) for gap in range(distance + 1) for i in range(distance + 1)
               for shift in range(max(-i, gap - (distance - i)), min(i, gap + (distance - i)) + 1)]
    return entries, [x for x in lookups if x not in entries]


def _keyed(distinct: DataFrame, distance: int, places: list) -> DataFrame:
    """(key, lid) of the lines' substrings at the places: a hash of the other
    line's length, the segment's number and the substring.  Of a length's
    segments the last ``length % parts`` are one longer."""
    parts = distance + 1
    spots = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(p, ("gap", "i", "shift"))]) for p in places])
    rows = distinct.select("lid", "line", "chars", F.explode(spots).alias("p"))
    rows = rows.select("lid", "line", "chars", "p.i", "p.shift", (F.col("chars") - F.col("p.gap")).cast("int").alias("n"))
    rows = rows.select("lid", "line", "chars", "i", "n", F.expr(f"n div {parts} + if(i >= {parts} - n % {parts}, 1, 0)").alias("size"),
                       F.expr(f"i * (n div {parts}) + greatest(0, i - {parts} + n % {parts}) + shift").alias("at"))
    rows = rows.where("at >= 0 AND at + size <= chars")
    return rows.select(F.expr("xxhash64(n, i, substring(line, cast(at + 1 AS INT), cast(size AS INT)))").alias("key"), "lid")


def edit_distance(longer: Column, shorter: Column, distance: int) -> Column:
    """Edits between two arrays of characters, if at most ``distance``; else
    some larger number.  ``longer`` has up to ``distance`` more characters.

    Bit k of a vector stands for row ``column - distance + k`` of the band.
    ``up``/``down``: rows one more/less than the row above; ``even``: cells
    equal to their upper left neighbour.  The value on the diagonal that ends
    in the last cell grows by one in each column where that cell is not even.

    The arrays are bound as a lambda's variable: written into the inner
    lambdas as expressions, they would be made again for every character.
    """
    pair = F.array(F.struct(longer.alias("a"), shorter.alias("b")))
    return F.element_at(F.transform(pair, lambda p: _distance(p["a"], p["b"], distance)), 1)


def _distance(longer: Column, shorter: Column, distance: int) -> Column:
    width = 2 * distance + 1
    mask = (1 << width) - 1
    end = F.size(longer) - F.size(shorter) + distance

    def matches(j: Column) -> Column:  # j counts the columns from 0
        bits = F.lit(0).cast("bigint")
        for k in range(width):
            same = F.get(longer, j - distance + k) == F.get(shorter, j)
            bits = bits + F.when(same, 1 << k).otherwise(0)
        return bits

    def column(state: Column, x: Column) -> Column:
        up, down = state["up"], state["down"]
        even = ((x.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(x).bitwiseOR(down).bitwiseAND(F.lit(mask))
        right = down.bitwiseOR(F.bitwise_not(even.bitwiseOR(up))).bitwiseAND(F.lit(mask))
        left = even.bitwiseAND(up)
        below = F.shiftright(even, 1)
        return F.struct(
            left.bitwiseOR(F.bitwise_not(below.bitwiseOR(right))).bitwiseAND(F.lit(mask)).cast("bigint").alias("up"),
            below.bitwiseAND(right).cast("bigint").alias("down"),
            (state["d"] + 1 - F.getbit(even, end)).cast("bigint").alias("d"))

    columns = F.when(F.size(shorter) > 0, F.transform(F.sequence(F.lit(0), F.size(shorter) - 1), matches)).otherwise(
        F.array().cast("array<bigint>"))
    start = F.struct(F.lit(mask & ~((1 << distance) - 1)).cast("bigint").alias("up"), F.lit(0).cast("bigint").alias("down"),
                     (F.size(longer) - F.size(shorter)).cast("bigint").alias("d"))
    return F.aggregate(columns, start, column, lambda s: s["d"])


def _meetings(distinct: DataFrame, distance: int) -> DataFrame:
    """(key, lid, entry, n): the entries and lookups of the lines (lid, line,
    chars) whose key others have too; n counts the key's entries."""
    at_entry, at_lookup = _places(distance)
    rows = _keyed(distinct, distance, at_entry).withColumn("entry", F.lit(True)).unionByName(
        _keyed(distinct, distance, at_lookup).withColumn("entry", F.lit(False)))
    key = Window.partitionBy("key")
    counted = rows.select("key", "lid", "entry", F.count(F.when(F.col("entry"), 1)).over(key).alias("n"),
                          F.count("*").over(key).alias("all"))
    return counted.where("n > 0 AND all > 1").drop("all")


def _met_pairs(met: DataFrame, distance: int) -> DataFrame:
    """(a, b): the pairs that meet under a key without a crowd."""
    few = met if distance != 2 else met.where(F.col("n") <= CROWD)
    one = few.where("entry").select("key", F.col("lid").alias("a"))
    same = one.join(one.withColumnRenamed("a", "b"), "key").where("a < b")
    other = one.join(few.where("not entry").select("key", F.col("lid").alias("b")), "key").where("a <> b")
    return same.select("a", "b").unionByName(other.select("a", "b")).distinct()


def _crowded(met: DataFrame, distance: int) -> DataFrame:
    """(lid): the lines that meet under a key with a crowd."""
    return met.where((F.col("n") > CROWD) & F.lit(distance == 2)).select("lid").distinct()


def _halves(rows: DataFrame) -> DataFrame:
    """Two stretches with one edit each: of either stretch the first or the
    last half is equal and goes into the key."""
    rows = rows.select("*", F.expr("length(t) - g").alias("c"), F.expr("length(u) - h").alias("d"))
    rows = rows.select("*", F.expr("cast(c div 2 AS INT)").alias("m"), F.expr("cast(d div 2 AS INT)").alias("k"), F.expr(
        "explode(CASE WHEN c > 1 AND d > 1 THEN array(0, 1, 2, 3) WHEN c > 1 THEN array(0, 1) "
        "WHEN d > 1 THEN array(0, 2) ELSE array(0) END)").alias("o"))
    same, rest = (
        "IF({o}, substring({t}, {m} + {g} + 1, length({t})), substring({t}, 1, {m}))",
        "IF({o}, substring({t}, 1, {m} + {g}), substring({t}, {m} + 1, length({t})))")
    first, second = {"o": "o % 2 = 1", "t": "t", "m": "m", "g": "g"}, {"o": "o > 1", "t": "u", "m": "k", "g": "h"}
    return rows.select(F.expr(f"xxhash64(key, o, c, d, {same.format(**first)}, {same.format(**second)})").alias("key"), "lid",
                       F.expr(rest.format(**first)).alias("t"), F.expr(rest.format(**second)).alias("u"), "g", "h")


def _narrowed(rows: DataFrame) -> DataFrame:
    """The rows of a crowd (see :func:`crowd_pairs`) under keys with half as
    much of their stretches left.  Two edits in one stretch: the first half
    is equal, or the last, or each half holds one edit; the first is then
    ``s`` longer (of equally long stretches either can be the entry, so one
    direction will do)."""
    one = rows.where("u IS NULL").select("key", "lid", "t", "g", F.expr("length(t) - g").alias("c"), F.expr(
        "explode(IF(g = 2, array(0, 1, 3), array(0, 1, 2, 3)))").alias("o"))
    one = one.select("*", F.expr("cast(c div 2 AS INT)").alias("m"), F.expr("IF(o = 3, 1, 0)").alias("s"))
    cut = one.select(
        F.expr("CASE o WHEN 0 THEN xxhash64(key, o, c, substring(t, 1, m)) WHEN 1 THEN xxhash64(key, o, c, substring(t, m + g + 1, "
               "length(t))) ELSE xxhash64(key, 2, c) END").alias("key"), "lid",
        F.expr("CASE o WHEN 0 THEN substring(t, m + 1, length(t)) WHEN 1 THEN substring(t, 1, m + g) "
               "ELSE substring(t, 1, m + s) END").alias("t"),
        F.expr("IF(o > 1, substring(t, m + s + 1, length(t)), NULL)").alias("u"),
        F.expr("IF(o > 1, s, g)").alias("g"), F.expr("IF(o > 1, g - s, 0)").alias("h"))
    two = cut.where("u IS NOT NULL").unionByName(rows.where("u IS NOT NULL").select("key", "lid", "t", "u", "g", "h"))
    return cut.where("u IS NULL").unionByName(_halves(two))


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose key can hold a pair, with n, the rows of their key.
    Stretches with one edit each differ both."""
    t, u = F.xxhash64("t"), F.xxhash64("u")
    keys = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.count(F.when(F.expr(ENTRY), 1)).alias("entries"), F.max(F.col("u").isNull()).alias("one"),
        (F.min(t) < F.max(t)).alias("t_differs"), (F.min(u) < F.max(u)).alias("u_differs"))
    keys = keys.where("entries > 0 AND n > 1 AND (one OR entries < n OR t_differs AND u_differs)")
    return lookup_join(rows, keys.select(F.col("key").alias("k"), "n"), ["key"], ["k"], "inner").drop("k")


#: Rows of a crowd as long as the shorter line of a pair; and those with so
#: little text left that what the key lacks can be said at once.
ENTRY = "g = 0 AND h = 0"
LAST = "length(t) - g <= 1 AND (u IS NULL OR length(u) - h <= 1)"


def _all_within(rows: DataFrame) -> DataFrame:
    """(key, lid, entry) of rows with at most one character of the shorter
    line's left in a stretch: an entry is within two edits of all of its key.
    Whatever the character is will do, unless the other line has as many
    more as there are edits: then the one must be among them."""
    def ways(t, g, most):
        return (f"CASE WHEN {ENTRY} THEN array_distinct(array('', {t})) WHEN {g} = {most} AND length({t}) > {g} "
                f"THEN array_distinct(split({t}, '')) ELSE array('') END")

    rows = rows.select("key", "lid", F.expr(ENTRY).alias("entry"), F.expr(
        f"IF(u IS NULL, array(''), {ways('u', 'h', '1')})").alias("ys"), F.explode(F.expr(ways("t", "g", "IF(u IS NULL, 2, 1)"))).alias("x"))
    return rows.select("key", "lid", "entry", "x", F.explode("ys").alias("y")).select(
        F.xxhash64("key", "x", "y").alias("key"), "lid", "entry")


def crowd_pairs(lines: DataFrame, linked: bool = False) -> DataFrame:
    """(a, b): the pairs of lines (lid, line, chars) within two edits, b as
    long as a or longer; if ``linked``, enough of them to link the same.

    A row is a line under the hash of what it must share with others, with
    the stretch that is left (t, two edits in it) or the two that are left
    (t and u, one edit in each), which are g and h longer than those of the
    key's entries.  A key of up to ``CLOSE`` rows is compared pair by pair,
    by what is left only; rows of larger ones get keys of more text, until
    so little is left that all lines of a key are within two edits.  Of
    those, the first is linked to each, or all pairs are given."""
    rows = lines.select("lid", F.col("line").alias("t"), F.lit(None).cast("string").alias("u"),
                        F.explode(F.array(*map(F.lit, range(3)))).alias("g"), F.lit(0).alias("h"))
    rows = rows.where("length(t) >= g").withColumn("key", F.expr("xxhash64(length(t) - g)"))
    found = None
    while True:
        met = written(_shared(written(rows, "crowd-rows", compression="zstd")), "crowd-meetings", compression="zstd")
        found = met if found is None else found.unionByName(met)
        many = met.where((F.col("n") > CLOSE) & ~F.expr(LAST))
        if many.isEmpty():
            break
        rows = _narrowed(many)
    few = found.where(F.col("n") <= CLOSE)
    one = few.where(ENTRY).select("key", F.col("lid").alias("a"), F.col("t").alias("t_a"), F.col("u").alias("u_a"))
    each = few.select("key", F.col("lid").alias("b"), "t", "u", F.expr(ENTRY).alias("entry"))
    fits = F.expr("a <> b AND (a < b OR NOT entry) AND IF(u IS NULL, levenshtein(t_a, t, 2) >= 0, "
                  "t <> t_a AND u <> u_a AND levenshtein(t_a, t, 1) >= 0 AND levenshtein(u_a, u, 1) >= 0)")
    pairs = one.join(each, "key").where(fits).select("a", "b")
    last = _all_within(found.where((F.col("n") > CLOSE) & F.expr(LAST)))
    one = last.where("entry").select("key", F.col("lid").alias("a"))
    if linked:
        first = one.groupBy("key").agg(F.min("a").alias("a")).withColumnRenamed("key", "k")
        rest = lookup_join(last.withColumnRenamed("lid", "b"), first, ["key"], ["k"], "inner").where("a <> b")
    else:
        rest = one.join(last.withColumnRenamed("lid", "b"), "key").where("a <> b AND (a < b OR NOT entry)")
    return pairs.unionByName(rest.select("a", "b")).distinct()


def candidate_pairs(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b): pairs of lines (lid, line, chars) that share a segment, or
    of a crowd are within the distance, b as long as a or longer."""
    met = written(_meetings(distinct, distance), "line-meetings")
    crowd = lookup_join(distinct, _crowded(met, distance).withColumnRenamed("lid", "need"), ["lid"], ["need"], "left_semi")
    found = _met_pairs(met, distance)
    return found.unionByName(crowd_pairs(crowd)).distinct() if distance == 2 else found


def _bound(value: Column, then) -> Column:
    """``then`` of a value that is computed once (see :func:`edit_distance`)."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _agree(long: Column, short: Column, distance: int) -> Column:
    """All but ``distance`` of the shorter line's pieces occur in the longer
    near their place."""
    n, found = F.length(short), F.lit(0)
    for i in range(PIECES):
        start, end = F.floor(n * i / PIECES).cast("int"), F.floor(n * (i + 1) / PIECES).cast("int")
        first = F.greatest(start - distance, F.lit(0))
        window = F.substring(long, first + 1, end + distance - first)
        found = found + F.contains(window, F.substring(short, start + 1, end - start)).cast("int")
    return found >= PIECES - distance


def _trimmed(p: Column) -> Column:
    """Two lines without the longest beginning, of some tried, that is the
    same in both."""
    n = F.least(F.length(p["a"]), F.length(p["b"]))
    tried = [F.floor(n * i / PIECES).cast("int") for i in range(1, PIECES + 1)]
    same = F.greatest(F.lit(0), *[F.when(F.substring(p["a"], F.lit(1), x) == F.substring(p["b"], F.lit(1), x), x) for x in tried])
    return _bound(same, lambda x: _pair(F.substring(p["a"], x + 1, F.length(p["a"])), F.substring(p["b"], x + 1, F.length(p["b"]))))


def _characters(c: Column) -> Column:
    return F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))


def verified(pairs: DataFrame, texts: DataFrame, distance: int) -> DataFrame:
    """The pairs (a, b) of lines (lid, line, chars) within the distance.
    What the two begin and end with alike is no part of the comparison."""
    short = texts.select(F.col("lid").alias("a"), F.col("line").alias("line_a"), F.col("chars").alias("chars_a"))
    long = texts.select(F.col("lid").alias("b"), F.col("line").alias("line_b"), F.col("chars").alias("chars_b"))
    # a fingerprint clash can pair lines of other lengths
    fits = pairs.join(short, "a").join(long, "b").where((F.col("chars_b") - F.col("chars_a")).between(0, distance))
    fits = fits.where(_agree(F.col("line_b"), F.col("line_a"), distance))
    turned = lambda p: _pair(F.reverse(p["a"]), F.reverse(p["b"]))
    edits = _bound(_trimmed(_pair(F.col("line_b"), F.col("line_a"))), lambda p: _bound(turned(p), lambda q: _bound(
        _trimmed(q), lambda r: edit_distance(_characters(r["a"]), _characters(r["b"]), distance))))
    return fits.where(edits <= distance).select("a", "b")


def near_lines(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b): the pairs of lines (lid, line, chars) within the distance."""
    return verified(candidate_pairs(distinct, distance), distinct, distance)


GRAM_STEP = 256


def allowed(n, percent: int, distance: int, near_chars: int):
    """Edits that a line of n characters may be away from a longer one:
    ``percent`` of n, and ``distance`` at least from ``near_chars`` on."""
    share = n * percent // 100 if isinstance(n, int) else F.floor(n * percent / 100).cast("int")
    if isinstance(n, int):
        return max(share, distance) if n >= near_chars else share
    return F.when(n >= near_chars, F.greatest(share, F.lit(distance))).otherwise(share)


def _gram_sizes(percent: int, distance: int, near_chars: int) -> list[tuple[int, int, int]]:
    """(first length, last length, characters of a gram): no segment of the
    lines of a class is shorter than its gram."""
    near = [n for n in range(1, 20_000 // percent) if allowed(n, percent, distance, near_chars)]
    cut = max(near_chars, (distance + 1) * 100 // percent)
    out = []
    for some in ([n for n in near if n < cut], [n for n in near if n >= cut]):
        if some:
            out.append((some[0], some[-1], min(max(1, n // (allowed(n, percent, distance, near_chars) + 1)) for n in some)))
    out[-1] = (out[-1][0], 2**31 - 1, out[-1][2])
    return out


def near_lines_by_length(distinct: DataFrame, percent: int, distance: int, near_chars: int) -> DataFrame:
    """(a, b): the pairs of lines (lid, line, chars) that are at most as many
    edits apart as :func:`allowed` gives the shorter one."""
    edits = allowed(F.col("chars"), percent, distance, near_chars)
    lines = distinct.withColumn("edits", edits)

    def band(n: Column) -> Column:  # about 6 % of length each
        return F.floor(F.ln(n) * 17).cast("int")

    def place(pos: Column) -> Column:  # about 10 % of the length each
        return F.floor(pos / (F.floor(F.exp((F.col("band") + 1) / 17) / 10) + 2)).cast("int")

    entries = lookups = None
    for first, last, gram in _gram_sizes(percent, distance, near_chars):
        e = lines.where(F.col("chars").between(first, last) & (F.col("edits") > 0)).select(
            "lid", "line", "chars", "edits", F.explode(F.sequence(F.lit(0), F.col("edits"))).alias("i"))
        at = (F.col("i") * F.floor(F.col("chars") / (F.col("edits") + 1))).cast("int")
        e = e.select("lid", "chars", "edits", at.alias("at"), F.substring("line", at + 1, F.lit(gram)).alias("gram"))
        e = e.select("lid", "edits", "at", "gram", F.explode(
            F.sequence(band(F.col("chars")), band(F.col("chars") + F.col("edits")))).alias("band"))
        e = e.select("lid", "gram", "band", F.explode(F.sequence(
            place(F.greatest(F.lit(0), F.col("at") - F.col("edits"))), place(F.col("at") + F.col("edits")))).alias("place"))
        e = e.select(F.col("lid").alias("a"), F.xxhash64(F.lit(gram), "band", "place", "gram").alias("key"))
        # the longer line can be of the next class
        most = last + (allowed(last, percent, distance, near_chars) if last < 2**31 - 1 else 0)
        b = lines.where(F.col("chars").between(first, most)).select(
            "lid", "line", band(F.col("chars")).alias("band"), (F.col("chars") - gram).alias("last"))
        # cut first: a substring is counted from the start of its text
        b = b.select("lid", "line", "band", "last", F.explode(F.sequence(F.lit(0), "last", F.lit(GRAM_STEP))).alias("s"))
        b = b.select("lid", "band", "s", F.least(F.col("last") - F.col("s"), F.lit(GRAM_STEP - 1)).alias("most"),
                     F.substring("line", F.col("s") + 1, F.lit(GRAM_STEP + gram - 1)).alias("piece"))
        b = b.select("lid", "band", "s", "piece", F.explode(F.sequence(F.lit(0), "most")).alias("o"))
        b = b.select(F.col("lid").alias("b"), F.xxhash64(
            F.lit(gram), "band", place(F.col("s") + F.col("o")), F.substring("piece", F.col("o") + 1, F.lit(gram))).alias("key"))
        entries, lookups = (e, b) if entries is None else (entries.unionByName(e), lookups.unionByName(b))
    pairs = entries.join(lookups, "key").where("a <> b").select("a", "b").distinct()
    short = lines.select(F.col("lid").alias("a"), F.col("line").alias("line_a"), F.col("chars").alias("chars_a"), "edits")
    long = distinct.select(F.col("lid").alias("b"), F.col("line").alias("line_b"), F.col("chars").alias("chars_b"))
    sizes = lines.select(F.col("lid").alias("a"), F.col("chars").alias("chars_a"), F.col("edits"))
    # lengths first: lines of one length find each other both ways
    fits = pairs.join(sizes, "a").join(long.select("b", "chars_b"), "b").where(
        F.col("chars_b").between(F.col("chars_a"), F.col("chars_a") + F.col("edits"))
        & ((F.col("chars_a") < F.col("chars_b")) | (F.col("a") < F.col("b")))).select("a", "b")
    both = fits.join(short.select("a", "line_a", "edits"), "a").join(long.select("b", "line_b"), "b")
    return both.where(F.expr("levenshtein(line_b, line_a, edits) >= 0")).select("a", "b")


def _groups(long: DataFrame, distance: int) -> DataFrame:
    """(l1, l2, g1, g2): lines linked to others, and their group's line."""
    each = long.distinct().select(F.col("h1").alias("lid"), "line", F.length("line").alias("chars"))
    met = written(_meetings(each, distance), "line-meetings")
    pairs = written(_met_pairs(met, distance), "line-pairs")
    crowd = written(_crowded(met, distance), "lines-in-crowds", rows=met.count())
    needed = written(pairs.select(F.explode(F.array("a", "b")).alias("need")).unionByName(
        crowd.select(F.col("lid").alias("need"))).distinct(), "lines-in-pairs", rows=met.count())
    # two lines of one h1 both come; h1 and h2 tell them apart
    texts = written(_small_or_split(long, needed, ["h1"], ["need"], "left_semi").distinct()
                    .select("h1", "h2", "line", F.length("line").alias("chars"), F.monotonically_increasing_id().alias("no")),
                    "line-texts", compression="zstd")
    ends = texts.select("h1", F.col("no").alias("lid"))
    named = pairs.join(ends.withColumnsRenamed({"h1": "a", "lid": "na"}), "a").join(
        ends.withColumnsRenamed({"h1": "b", "lid": "nb"}), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    lines = texts.select(F.col("no").alias("lid"), "line", "chars")
    crowded = _small_or_split(texts, crowd, ["h1"], ["lid"], "left_semi").select(F.col("no").alias("lid"), "line", "chars")
    if distance == 2:
        named = named.unionByName(crowd_pairs(crowded, linked=True)).distinct()
    near = written(verified(named, lines, distance), "near-lines")
    found = components(near)
    return _named_groups(found, texts.select("no", "h1", "h2"))


def _groups_by_length(long: DataFrame, percent: int, distance: int, near_chars: int) -> DataFrame:
    distinct = written(long.distinct().select("h1", "h2", "line", F.length("line").alias("chars"),
                                              F.monotonically_increasing_id().alias("no")), "distinct-lines", compression="zstd")
    each = distinct.select(F.col("no").alias("lid"), "line", "chars")
    found = components(written(near_lines_by_length(each, percent, distance, near_chars), "near-lines"))
    return _named_groups(found, distinct.select("no", "h1", "h2"))


def _named_groups(found: DataFrame, lines: DataFrame) -> DataFrame:
    one = lines.select(F.col("no").alias("node"), F.col("h1").alias("l1"), F.col("h2").alias("l2"))
    top = lines.select(F.col("no").alias("component"), F.col("h1").alias("g1"), F.col("h2").alias("g2"))
    return written(found.join(one, "node").join(top, "component").select("l1", "l2", "g1", "g2"), "line-groups")


def line_verdicts(docs: DataFrame, distance: int = 2, near_chars: int = 30, id_col: str = "doc_id",
                  text_col: str = "text", percent: int | None = None) -> DataFrame:
    """One row per line: rid (number of the document's row), id, pos (from
    0), removed, near (removed for a line that is not equal).  With
    ``percent``, near lines are those :func:`allowed` says."""
    least = near_chars if percent is None else min(near_chars, -(-100 // percent))
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    lines = rows.select("rid", "id", F.posexplode_outer(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("rid", "id", "pos", "line", F.xxhash64("line").alias("h1"),
                         F.xxhash64(F.lit(1), "line").alias("h2"))
    # 128 bits stand for a line from here on
    places = written(lines.select("rid", "id", "pos", F.col("line").isNull().alias("none"), "h1", "h2",
                                  (F.coalesce(F.length("line"), F.lit(0)) == 0).alias("blank")), "lines")
    long = lines.where(F.length("line") >= least).select("h1", "h2", "line")
    groups = _groups(long, distance) if percent is None else _groups_by_length(long, percent, distance, near_chars)
    # what is in no group is its own
    seen = F.struct(F.col("id").isNull(), F.col("id"), F.col("pos"), F.col("rid"))
    grouped = _small_or_split(places.where("not blank"), groups, ["h1", "h2"], ["l1", "l2"], "left").withColumn(
        "g1", F.coalesce("g1", "h1")).withColumn("g2", F.coalesce("g2", "h2")).drop("l1", "l2")
    # lines that occur once need no verdict
    first = written(grouped.groupBy("g1", "g2").agg(
        F.min(F.struct(seen.alias("o"), "h1", "h2")).alias("first"), F.count("*").alias("n")).where("n > 1").select(
        F.col("g1").alias("f1"), F.col("g2").alias("f2"), "first"), "first-lines")
    judged = _small_or_split(grouped, first, ["g1", "g2"], ["f1", "f2"], "left").select(
        "rid", "id", "pos", (F.coalesce(F.col("first.o") != seen, F.lit(False))).alias("removed"),
        F.coalesce((F.col("first.h1") != F.col("h1")) | (F.col("first.h2") != F.col("h2")), F.lit(False)).alias("near"))
    blank = places.where("blank").select("rid", "id", F.when(~F.col("none"), F.col("pos")).alias("pos"),
                                         F.lit(False).alias("removed"), F.lit(False).alias("near"))
    return judged.unionByName(blank)


def removed_lines(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: id, n_lines, n_removed, n_near, removed (the line
    numbers from 0, ascending)."""
    found = line_verdicts(docs, id_col=id_col, **options)
    per = found.groupBy("rid", "id").agg(
        F.count("pos").alias("n_lines"), F.count(F.when(F.col("removed"), 1)).alias("n_removed"),
        F.count(F.when(F.col("near"), 1)).alias("n_near"),
        F.sort_array(F.collect_list(F.when(F.col("removed"), F.col("pos")))).alias("removed"))
    return per.drop("rid").withColumnRenamed("id", id_col)


def without_lines(text: Column, removed: Column) -> Column:
    """A text without the lines of the given numbers (ascending array)."""
    numbered = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    kept = F.filter(numbered, lambda x: ~F.array_contains(removed, x["i"]))
    return F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
