"""The registered queries of the operators: each applies one operator with
production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wareshift.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query("op10_token_ids")
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wareshift.llm.token_ids import read_token_ids, write_token_ids
    from wareshift.session import scratch_path

    out = scratch_path(spark, "op10")
    write_token_ids(table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), end_id=2,
                    by_word=True)
    return read_token_ids(spark, out)


@query("op5_mix_sources", r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w
  FROM sized GROUP BY source
), level AS (
  -- with the sources before it (by size for weight) at their caps: words and weights left
  SELECT *, 1.5::DOUBLE * sum(n) OVER () - 2.0::DOUBLE * coalesce(sum(n) OVER earlier, 0) AS words,
         sum(w) OVER () - coalesce(sum(w) OVER earlier, 0) AS weights
  FROM per
  WINDOW earlier AS (ORDER BY n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), open AS (
  SELECT words, weights FROM level WHERE 2.0::DOUBLE * n * weights > words * w
  ORDER BY n / w, source NULLS LAST LIMIT 1
), goal AS (
  SELECT source, n, CASE WHEN 2.0::DOUBLE * n * level.weights <= level.words * w THEN 2.0::DOUBLE * n
                         ELSE open.words * w / open.weights END AS target,
         CAST('0x' || substr(md5('0:' || coalesce('=' || source, 'null')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM level LEFT JOIN open ON true
), ranked AS (
  SELECT doc_id, source, size,
         CAST(row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS DOUBLE) AS k
  FROM sized
)
SELECT doc_id, size, n AS source_size, target,
       CASE WHEN n = 0 THEN 0 ELSE size * CAST(floor(u + k * target / n) - floor(u + (k - 1) * target / n) AS BIGINT)
       END AS taken
FROM ranked r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source
""")
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wareshift.llm.mixing import plan_mix

    plan = plan_mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return plan.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _pii_sql() -> str:
    """The contract's patterns as they stand, with the added kinds."""
    from wareshift.llm.pii import CONTEXT, KINDS

    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
        "national_phone": r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}",
    }
    found = "\nUNION ALL\n".join(
        f"SELECT rid, {no} AS no, '{k.name}' AS kind, regexp_extract_all(t, '{plain[k.name]}') AS found, "
        f"string_split_regex(t, '{plain[k.name]}') AS parts FROM d WHERE regexp_matches(t, '{plain[k.name]}')"
        for no, k in enumerate(KINDS))
    near = "regexp_matches(around, '(^|[^a-z])({})([^a-z]|$)')".format
    scores = " ".join(
        f"WHEN '{k.name}' THEN {k.score}::DOUBLE + CASE WHEN {near(k.words)} THEN {k.raises} ELSE 0 END"
        + (f" - CASE WHEN {near(k.lowers_words)} THEN {k.lowers} ELSE 0 END" if k.lowers else "") for k in KINDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
e AS (SELECT rid, no, kind, unnest(found) AS found, unnest(parts[:len(found)]) AS before,
             unnest(parts[2:]) AS after, generate_subscripts(found, 1) AS pos FROM m),
s AS (
  SELECT *, CAST(sum(length(before) + length(found)) OVER (PARTITION BY rid, no ORDER BY pos) AS BIGINT) AS stop,
         lower(right(before, {CONTEXT}) || ' ' || left(after, {CONTEXT})) AS around,
         regexp_replace(found, '[^0-9]', '', 'g') AS digits FROM e
), c AS (
  SELECT *, stop - length(found) AS start,
    CASE kind
      WHEN 'email' THEN true
      WHEN 'ip' THEN list_max(list_transform(string_split(found, '.'), lambda p: CAST(p AS HUGEINT))) <= 255
      WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(
             string_split(reverse(digits), ''),
             lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INT) WHEN CAST(x AS INT) > 4
                          THEN CAST(x AS INT) * 2 - 9 ELSE CAST(x AS INT) * 2 END)) % 10 = 0
      WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
      WHEN 'iban' THEN list_reduce(list_prepend(0::HUGEINT, list_transform(
             string_split(replace(found, ' ', '')[5:] || replace(found, ' ', '')[:4], ''),
             lambda x: CAST(CASE WHEN x BETWEEN '0' AND '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END AS HUGEINT))),
             lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1
      ELSE NOT regexp_matches(right(before, {CONTEXT}), '\+[0-9 ]*$')
    END AS ok,
    CASE kind {scores} END AS score
  FROM s
), kept AS (SELECT * FROM c WHERE ok AND (no < 4 OR score >= 0.5)),
g AS (
  SELECT rid, count(*) FILTER (no = 0) AS n0, count(*) FILTER (no = 1) AS n1, count(*) FILTER (no = 2) AS n2,
         count(*) FILTER (no = 3) AS n3,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY no, start) FILTER (no < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY no, start) AS spans
  FROM kept GROUP BY rid
)
SELECT doc_id, coalesce(n0, 0) AS n_email, coalesce(n1, 0) AS n_ip, coalesce(n2, 0) AS n_card,
       coalesce(n3, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


@query("op8_pii", _pii_sql())
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wareshift.llm.pii import BASE, count, digest, find_pii

    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    counts = [count(spans, k).alias(f"n_{k}") for k in BASE]
    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(digest(base), 256).alias("base_sha256"), digest(spans).alias("spans"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wareshift.llm.toxicity import held_out, learn, score_documents

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model, ["doc_id"], threshold=0.7).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted", "n_hits")


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareshift.llm.ann import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"), query_every=100, k=10)


@query("op7_decontamination", r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, row_number() OVER () AS rid,
         regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM texts WHERE text IS NOT NULL
), item AS (
  SELECT rid, id, least(len(w), 5) AS n, w FROM words WHERE kind = 'b' AND len(w) > 0
), item_shingle AS (
  SELECT DISTINCT rid, id, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM item)
), sized AS (
  SELECT *, count(*) OVER (PARTITION BY rid) AS n_item FROM item_shingle
), doc_shingle AS (
  SELECT DISTINCT rid, id, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT rid, id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM item) WHERE kind = 'd' AND len(w) >= n)
)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item,
       count(*) / CAST(any_value(n_item) AS DOUBLE) AS containment
FROM doc_shingle d JOIN sized b ON d.n = b.n AND d.s = b.s
GROUP BY d.rid, d.id, b.rid, b.id
HAVING count(*) * 10 >= any_value(n_item) * 8
""")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wareshift.llm.decontaminate import mark

    marked = mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    found = marked.select("row.doc_id", F.explode("items").alias("i"))
    return found.select("doc_id", "i.item_id", F.col("i.shared").alias("n_shared"), F.col("i.size").alias("n_item"),
                        (F.col("i.shared") / F.col("i.size")).alias("containment"))


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareshift.llm.jaccard import jaccard_components

    found = jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wareshift.llm.substrings import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query("op6_line_dedup", r"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(text, chr(10)) AS lines FROM documents
), line AS (
  SELECT rid, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM doc
), each AS (
  SELECT row_number() OVER () AS lid, line, length(line) AS chars, length(line) // 3 AS third
  FROM (SELECT DISTINCT line FROM line WHERE length(line) >= 30)
), pair AS (
  -- two edits leave one third of the shorter line whole
  SELECT a.line AS a, b.line AS b FROM each a JOIN each b ON b.chars BETWEEN a.chars AND a.chars + 2 AND a.lid <> b.lid
  WHERE (contains(b.line, left(a.line, a.third)) OR contains(b.line, substr(a.line, a.third + 1, a.third))
         OR contains(b.line, substr(a.line, 2 * a.third + 1)))
    AND levenshtein(a.line, b.line) <= 2
), edge AS (
  SELECT a, b FROM pair UNION SELECT b, a FROM pair
), reach(line, other) AS (
  SELECT a, a FROM edge UNION SELECT r.line, e.b FROM reach r JOIN edge e ON r.other = e.a
), grp AS (
  SELECT line, min(other) AS g FROM reach GROUP BY line
), placed AS (
  SELECT rid, doc_id, pos, l.line, coalesce(g, l.line) AS g FROM line l LEFT JOIN grp ON l.line = grp.line
), judged AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) > 1 AND line <> '' AS removed,
         line <> first_value(line) OVER (PARTITION BY g ORDER BY doc_id, pos) AS near
  FROM placed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed, count(*) FILTER (near) AS n_near,
       coalesce(string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FILTER (removed), '') AS removed
FROM judged GROUP BY rid, doc_id
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wareshift.llm.lines import removed_lines

    found = removed_lines(table(spark, sf_dir, "documents"), distance=2, near_chars=30)
    numbers = F.array_join(F.col("removed").cast("array<string>"), ",")
    return found.select("doc_id", "n_lines", "n_removed", "n_near", numbers.alias("removed"))


@query("op6_line_dedup_by_length")  # no SQL: DuckDB's levenshtein counts bytes; tests/llm compare with brute force
def op6_line_dedup_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from wareshift.llm.lines import removed_lines

    found = removed_lines(table(spark, sf_dir, "documents"), distance=2, near_chars=30, percent=5)
    numbers = F.array_join(F.col("removed").cast("array<string>"), ",")
    return found.select("doc_id", "n_lines", "n_removed", "n_near", numbers.alias("removed"))


@query("op12_bpe_round_trip")
def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wareshift.llm.bpe import round_trip_digests

    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), by_word=True)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareshift.llm.whitening import by_component, whiten

    return by_component(whiten(table(spark, sf_dir, "embeddings"), components=32))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wareshift.llm.conversations import damage, repair_report

    return repair_report(damage(table(spark, sf_dir, "conversations")))
