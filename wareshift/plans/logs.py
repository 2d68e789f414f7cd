"""Query-log queries on the driver tables.

``events`` stands in for the statement log: one logged statement per
event, with statement texts and error messages built from the event's own
columns (the templates exercise each rewrite/noise/classification rule).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareshift.functions import rules as RU
from wareshift.operators import aggregates as A
from wareshift.operators import changes as D
from wareshift.operators import filters as P
from wareshift.operators import querylog as L
from wareshift.operators.changes import with_sequence
from wareshift.plans.common import tables
from wareshift.plans.registry import register
from wareshift.session import scratch_path
from wareshift.sources.sequences import with_stored_sequence

SQL_DATE = "0115"

# Statement templates, chosen by event_id % 8: (prefix, middle, suffix)
# pieces joined around the event's own values.
STATEMENT_TEMPLATES = [
    ("/*& requestId:{id} */ select * from {{{{tenant}}}}_{type} where k = {props}"),
    ("select isnull(a, 0), cast(b as string) from global_dw.{type} order by a NULLS FIRST"),
    ("select nullvalue(x) --note\nfrom t_{type} ..."),
    ("select regexp_replace(name, 'a', 'b') from {type} full join x on 1=1"),
    ("select NDV(id) from {type}_parquet_"),
    ("/*& background:true */ insert into {type} values ({props})"),
    ("select CAST(v AS STRING), cast (w as string) from x___{type}"),
    ("select isNull(v, 1) /*& tenant:x */ from {{{{tenant}}}}.orders where id = {id}"),
]

# Error messages of failed statements, chosen by event_id % 11: one per
# classification rule plus texts that match none or two rules.
ERROR_TEXTS = [
    "Duplicate entry '7' for key 'PRIMARY' in insert into t",
    "Expression #1 of SELECT list is not in GROUP BY clause; this is incompatible with sql_mode=only_full_group_by",
    "Incorrect datetime value: '0000-00-00' for column 'd'",
    "Column 'org_id' cannot be null",
    "Invalid transaction",
    "Table 'global_app.t' doesn't exist",
    "sql文本长度超过最大解析长度",
    "Lost connection to server during query",
    "Query execution was interrupted",
    "Unknown column 'x' in 'field list'",
    "Duplicate entry 'x' for key 'uk'",
]


def _template_sql(tpl: str) -> str:
    """Template -> DuckDB string expression."""
    out, rest = [], tpl.replace("{{{{tenant}}}}", "\x00")
    import re

    for piece in re.split(r"(\{id\}|\{type\}|\{props\})", rest):
        if piece == "{id}":
            out.append("CAST(event_id AS VARCHAR)")
        elif piece == "{type}":
            out.append("event_type")
        elif piece == "{props}":
            out.append("props")
        elif piece:
            lit = piece.replace("'", "''").replace("\x00", "{{tenant}}")
            if "\n" in lit:
                a, b = lit.split("\n")
                out.append(f"'{a}' || chr(10) || '{b}'")
            else:
                out.append(f"'{lit}'")
    return " || ".join(out)


def _template_col(tpl: str):
    import re

    rest = tpl.replace("{{{{tenant}}}}", "\x00")
    parts = []
    for piece in re.split(r"(\{id\}|\{type\}|\{props\})", rest):
        if piece == "{id}":
            parts.append(F.col("event_id").cast("string"))
        elif piece == "{type}":
            parts.append(F.col("event_type"))
        elif piece == "{props}":
            parts.append(F.col("props"))
        elif piece:
            parts.append(F.lit(piece.replace("\x00", "{{tenant}}")))
    return F.concat(*parts)


def _choice_sql(key: str, n: int, texts: list[str]) -> str:
    whens = " ".join(f"WHEN {key} % {n} = {i} THEN {t}" for i, t in enumerate(texts))
    return f"CASE {whens} END"


def _choice_col(key: str, n: int, exprs):
    k = F.col(key) % n
    out = None
    for i, e in enumerate(exprs):
        out = F.when(k == i, e) if out is None else out.when(k == i, e)
    return out


LOG_SQL = f"""
log AS (
    SELECT 'q-' || CAST(event_id AS VARCHAR) AS query_id,
           event_id AS order_id,
           md5(event_type || props) AS hash_id,
           'u' || CAST(user_id AS VARCHAR) || CASE user_id % 3 WHEN 0 THEN '_internal_read' WHEN 1 THEN '_internal_write' ELSE '' END AS user_name,
           CASE user_id % 4 WHEN 0 THEN 't' || CAST(user_id AS VARCHAR) || '_custom' WHEN 1 THEN 'default'
                ELSE 'global_app' || CAST(user_id % 5 AS VARCHAR) END AS db,
           event_type AS sql_type,
           value AS duration,
           ts AS created_at,
           strftime(ts, '%m%d') AS sql_date,
           CASE WHEN value >= 10 THEN 'slow' ELSE 'normal' END AS type,
           CASE WHEN event_type = 'error' THEN 'EXCEPTION' ELSE 'FINISHED' END AS query_state,
           {_choice_sql('event_id', 8, [_template_sql(t) for t in STATEMENT_TEMPLATES])} AS statement,
           CASE WHEN event_type = 'error' THEN {_choice_sql('event_id', 11, ["'" + e.replace("'", "''") + "'" for e in ERROR_TEXTS])} END AS err_msg,
           event_id, event_type, value, user_id
    FROM events
)"""


def event_log(spark, sf_dir):
    e = tables(spark, sf_dir).events
    u = F.col("user_id")
    return e.select(
        F.concat(F.lit("q-"), F.col("event_id").cast("string")).alias("query_id"),
        F.col("event_id").alias("order_id"),
        F.md5(F.concat("event_type", "props")).alias("hash_id"),
        F.concat(F.lit("u"), u.cast("string"),
                 F.when(u % 3 == 0, "_internal_read").when(u % 3 == 1, "_internal_write").otherwise("")).alias("user_name"),
        F.when(u % 4 == 0, F.concat(F.lit("t"), u.cast("string"), F.lit("_custom")))
        .when(u % 4 == 1, F.lit("default"))
        .otherwise(F.concat(F.lit("global_app"), (u % 5).cast("string"))).alias("db"),
        F.col("event_type").alias("sql_type"),
        F.col("value").alias("duration"),
        F.col("ts").alias("created_at"),
        F.date_format("ts", "MMdd").alias("sql_date"),
        F.when(F.col("value") >= 10, "slow").otherwise("normal").alias("type"),
        F.when(F.col("event_type") == "error", "EXCEPTION").otherwise("FINISHED").alias("query_state"),
        _choice_col("event_id", 8, [_template_col(t) for t in STATEMENT_TEMPLATES]).alias("statement"),
        F.when(F.col("event_type") == "error", _choice_col("event_id", 11, [F.lit(x) for x in ERROR_TEXTS])).alias("err_msg"),
        "event_id", "event_type", "value", "user_id",
    )


def W(body: str) -> str:
    return f"WITH {LOG_SQL}" + ("," if not body.lstrip().upper().startswith("SELECT") else "") + "\n" + body


# L1
@register("log_slow", W("""
SELECT query_id, order_id, db, hash_id, created_at FROM log
WHERE type = 'slow' AND query_state = 'FINISHED' AND duration < 30 AND statement NOT LIKE '%...%'
ORDER BY created_at, hash_id
"""), "L1,T1")
def log_slow(spark, sf_dir):
    return L.slow_statements(event_log(spark, sf_dir)).select("query_id", "order_id", "db", "hash_id", "created_at")


# L2
@register("log_strip_hints", W(f"""
SELECT query_id, regexp_replace(statement, '{RU.HINT_PATTERN.replace('(?d)', '')}', '', 'g') AS stripped FROM log
"""), "L2,F10")
def log_strip_hints(spark, sf_dir):
    return event_log(spark, sf_dir).select("query_id", L.strip_hints("statement").alias("stripped"))


_TENANT_SQL = """
t AS (
    SELECT query_id, db, user_name, regexp_replace(statement, '(/\\*&.*\\*/)', '', 'g') AS statement FROM log
),
r AS (
    SELECT *, CASE WHEN regexp_matches(user_name, '(.*)_internal_(write|read)')
                   THEN regexp_extract(user_name, '(.*)_internal_(write|read)', 1)
                   WHEN ends_with(db, '_custom') THEN replace(db, '_custom', '') END AS tenant
    FROM t
)"""


# L3
@register("log_tenant", W(_TENANT_SQL + """
SELECT query_id, db, user_name,
       CASE WHEN contains(statement, '{{tenant}}') THEN replace(statement, '{{tenant}}', tenant) ELSE statement END AS statement
FROM r WHERE NOT contains(statement, '{{tenant}}') OR tenant IS NOT NULL
"""), "L3,F9")
def log_tenant(spark, sf_dir):
    log = event_log(spark, sf_dir).select("query_id", "db", "user_name", L.strip_hints("statement").alias("statement"))
    return L.resolve_tenant(log, "statement", "user_name", "db")


def _rewrite_sql(x: str) -> str:
    steps = list(RU.TEXT_REWRITES_BEFORE_RENAMES) + list(RU.DEFAULT_TEXT_RENAMES) + list(RU.TEXT_REWRITES_AFTER_RENAMES)
    for old, new in steps:
        x = f"replace({x}, '{old}', '{new}')"
    return x


# L4
@register("log_rewrite", W(f"""
x AS (SELECT query_id, db, value < 15 AS enabled, {_rewrite_sql('statement')} AS s FROM log)
SELECT query_id, CASE WHEN db = 'default' THEN 'global_platform' ELSE db END AS db,
       CASE WHEN enabled THEN regexp_replace(s, '(?i)cast\\((.+?) as string\\)', 'concat(\\1)', 'g') ELSE s END AS sql_tidb
FROM x
"""), "L4,F10")
def log_rewrite(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return log.select("query_id", L.rename_db("db").alias("db"),
                      L.rewrite_text("statement", F.col("value") < 15).alias("sql_tidb"))


# L5
@register("log_noise", W("""
SELECT query_id, db FROM log
WHERE NOT (contains(statement, '_parquet_') OR contains(statement, 'NDV(') OR contains(statement, 'background:true')
           OR contains(statement, 'impala_query_log') OR contains(statement, 'x___') OR contains(statement, '/*& requestId'))
  AND db NOT IN ('global_app3')
"""), "L5")
def log_noise(spark, sf_dir):
    return L.drop_noise(event_log(spark, sf_dir), drop_dbs=["global_app3"]).select("query_id", "db")


def _classify_sql(sql: str, err: str) -> str:
    f = {"sql": f"lower(coalesce({sql}, ''))", "err": f"lower(coalesce({err}, ''))"}
    whens = []
    for cat, groups in RU.ERROR_RULES:
        conds = []
        for field, needles in groups:
            conds.append("(" + " OR ".join(f"contains({f[field]}, '{n.replace(chr(39), chr(39) * 2)}')" for n in needles) + ")")
        whens.append(f"WHEN {' AND '.join(conds)} THEN '{cat}'")
    return f"CASE {' '.join(whens)} ELSE '{RU.DEFAULT_CATEGORY}' END"


_ERRORS_SQL = f"""
errors AS (
    SELECT query_id, sql_date, hash_id, err_msg, {_classify_sql('statement', 'err_msg')} AS catalog, statement, event_id
    FROM log WHERE event_type = 'error'
)"""


def _errors(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return log.filter(F.col("event_type") == "error").select(
        "query_id", "sql_date", "hash_id", "err_msg", L.classify_error("statement", "err_msg").alias("catalog"),
        "statement", "event_id")


# L6
@register("log_classify", W(_ERRORS_SQL + "\nSELECT query_id, catalog FROM errors"), "L6")
def log_classify(spark, sf_dir):
    return _errors(spark, sf_dir).select("query_id", "catalog")


# L7
@register("log_ignored", W(_ERRORS_SQL + """
SELECT catalog, CAST(count(*) AS BIGINT) AS n FROM errors
WHERE catalog NOT IN ('ignore_duplicate_insert', 'ignore_etl') GROUP BY catalog
"""), "L7,A1")
def log_ignored(spark, sf_dir):
    return L.drop_ignored(_errors(spark, sf_dir)).groupBy("catalog").agg(F.count(F.lit(1)).alias("n"))


# Statements table of the replay: failed translations have empty text;
# every tenth statement already ran.
_STATEMENTS_SQL = """
statements AS (
    SELECT query_id, order_id, hash_id, db, sql_type, sql_date, statement AS impala_sql,
           CASE WHEN event_type = 'signup' THEN '' ELSE statement END AS tidb_sql,
           CAST(CASE WHEN event_id % 10 = 0 THEN 1 END AS INTEGER) AS execute_result,
           CAST(NULL AS DOUBLE) AS tidb_duration, CAST(NULL AS TIMESTAMP) AS execute_time,
           value > 15 AS tiflash_only, event_id, err_msg, duration, created_at
    FROM log
)"""


def _statements(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return log.select(
        "query_id", "order_id", "hash_id", "db", "sql_type", "sql_date", F.col("statement").alias("impala_sql"),
        F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.col("statement")).alias("tidb_sql"),
        F.when(F.col("event_id") % 10 == 0, F.lit(1)).cast("int").alias("execute_result"),
        F.lit(None).cast("double").alias("tidb_duration"), F.lit(None).cast("timestamp_ntz").alias("execute_time"),
        (F.col("value") > 15).alias("tiflash_only"), "event_id", "err_msg", "duration", "created_at")


def _results(st):
    """Executed statements: those with a duration over 2 ran; errors carry
    their message; 'interrupted' marks a timeout."""
    return st.filter(F.col("duration") > 2).select(
        "query_id", "hash_id", F.col("tidb_sql").alias("sql"), F.coalesce("err_msg", F.lit("")).alias("err_msg"),
        "duration", F.col("created_at").alias("executed_at"),
        F.coalesce(F.col("err_msg").contains("interrupted"), F.lit(False)).alias("timed_out"))


# L8
@register("log_outcome", W(_STATEMENTS_SQL + f""",
results AS (
    SELECT query_id, tidb_sql AS sql, coalesce(err_msg, '') AS err_msg, duration, created_at AS executed_at,
           coalesce(contains(err_msg, 'interrupted'), false) AS timed_out
    FROM statements WHERE duration > 2
)
SELECT s.query_id,
       CASE WHEN r.query_id IS NOT NULL THEN CAST(CASE WHEN r.err_msg <> '' THEN 0 ELSE 1 END AS INTEGER) ELSE s.execute_result END AS execute_result,
       CASE WHEN r.query_id IS NOT NULL THEN r.duration ELSE s.tidb_duration END AS tidb_duration,
       CASE WHEN r.query_id IS NOT NULL THEN r.executed_at ELSE s.execute_time END AS execute_time,
       CASE WHEN r.err_msg = '' OR r.query_id IS NULL THEN NULL WHEN r.timed_out THEN 'timeout'
            ELSE {_classify_sql('r.sql', 'r.err_msg')} END AS catalog
FROM statements s LEFT JOIN results r ON r.query_id = s.query_id
"""), "L8,D3")
def log_outcome(spark, sf_dir):
    st = _statements(spark, sf_dir)
    res = _results(st)
    out = L.record_outcome(st, res)
    cats = L.outcome_rows(res).select("query_id", "catalog")
    return out.join(cats, "query_id", "left").select("query_id", "execute_result", "tidb_duration", "execute_time", "catalog")


# L9
@register("log_claim", W(_STATEMENTS_SQL + """
SELECT query_id, order_id FROM statements
WHERE execute_result IS NULL AND order_id > 100 AND coalesce(tidb_sql, '') <> '' AND coalesce(db, '') <> ''
ORDER BY order_id LIMIT 500
"""), "L9,T6")
def log_claim(spark, sf_dir):
    return L.claim_batch(_statements(spark, sf_dir), 100, 500).select("query_id", "order_id")


# L10
_RETRY_CATS = ["delay", "not_processed", "modify_date_format"]


# The error rows of failed statements are upserted into those kept from
# the translation, ignored categories left out.
@register("log_record_errors", W(_ERRORS_SQL + "," + _STATEMENTS_SQL + f""",
kept AS (SELECT query_id, sql_date, hash_id, err_msg, 'translate_error' AS catalog FROM errors WHERE event_id % 2 = 0),
failed AS (
    SELECT query_id, '{SQL_DATE}' AS sql_date, hash_id, coalesce(err_msg, '') AS err_msg,
           CASE WHEN contains(err_msg, 'interrupted') THEN 'timeout' ELSE {_classify_sql('tidb_sql', 'err_msg')} END AS catalog
    FROM statements WHERE duration > 2 AND coalesce(err_msg, '') <> ''
), fresh AS (SELECT * FROM failed WHERE catalog NOT IN ('ignore_duplicate_insert', 'ignore_etl'))
SELECT coalesce(k.query_id, f.query_id) AS query_id, coalesce(k.sql_date, f.sql_date) AS sql_date,
       coalesce(k.hash_id, f.hash_id) AS hash_id, coalesce(f.err_msg, k.err_msg) AS err_msg, coalesce(f.catalog, k.catalog) AS catalog
FROM kept k FULL JOIN fresh f ON k.query_id = f.query_id
"""), "L8,L7,D1")
def log_record_errors(spark, sf_dir):
    kept = _errors(spark, sf_dir).filter(F.col("event_id") % 2 == 0).select(
        "query_id", "sql_date", "hash_id", "err_msg", F.lit("translate_error").alias("catalog"))
    return L.record_errors(kept, _results(_statements(spark, sf_dir)), SQL_DATE)


@register("log_retry", W(_ERRORS_SQL + "," + _STATEMENTS_SQL + f"""
SELECT e.query_id, e.catalog, s.sql_type, s.tiflash_only
FROM errors e JOIN statements s ON s.query_id = e.query_id
WHERE e.catalog IN ({', '.join(f"'{c}'" for c in _RETRY_CATS)}) AND e.sql_date = '{SQL_DATE}'
"""), "L10,J18")
def log_retry(spark, sf_dir):
    return L.retry_worklist(_errors(spark, sf_dir), _statements(spark, sf_dir), _RETRY_CATS, SQL_DATE)


# L10 apply: translated retries either succeed (error row deleted), fail
# again (re-classified) or fail to translate (translate_error).
@register("log_retry_apply", W(_ERRORS_SQL + "," + _STATEMENTS_SQL + f""",
attempts AS (
    SELECT query_id, event_id % 4 <> 0 AS translated, replace(statement, 'isnull(', 'ifnull(') AS new_sql,
           CASE WHEN event_id % 3 = 0 THEN 'Invalid transaction' WHEN event_id % 3 = 1 THEN 'Lost connection' ELSE '' END AS err_msg
    FROM errors WHERE catalog IN ({', '.join(f"'{c}'" for c in _RETRY_CATS)})
),
a AS (SELECT *, translated AND err_msg = '' AS ok FROM attempts)
SELECT e.query_id,
       'error' AS part,
       CASE WHEN a.query_id IS NULL THEN e.err_msg ELSE a.err_msg END AS body,
       CASE WHEN a.query_id IS NULL THEN e.catalog WHEN NOT a.translated THEN 'translate_error'
            ELSE {_classify_sql('a.new_sql', 'a.err_msg')} END AS catalog,
       CAST(NULL AS INTEGER) AS execute_result
FROM errors e LEFT JOIN a ON a.query_id = e.query_id
WHERE a.query_id IS NULL OR NOT a.ok
UNION ALL
SELECT s.query_id, 'statement',
       CASE WHEN a.query_id IS NULL THEN s.tidb_sql WHEN a.translated THEN a.new_sql ELSE '' END, NULL,
       CASE WHEN a.query_id IS NULL THEN s.execute_result WHEN NOT a.translated THEN NULL WHEN a.ok THEN 1 ELSE 0 END
FROM statements s LEFT JOIN a ON a.query_id = s.query_id
"""), "L10,D3,D7")
def log_retry_apply(spark, sf_dir):
    errors = _errors(spark, sf_dir)
    st = _statements(spark, sf_dir)
    k = F.col("event_id")
    attempts = errors.filter(F.col("catalog").isin(_RETRY_CATS)).select(
        "query_id", (k % 4 != 0).alias("translated"),
        F.replace("statement", F.lit("isnull("), F.lit("ifnull(")).alias("new_sql"),
        F.when(k % 3 == 0, "Invalid transaction").when(k % 3 == 1, "Lost connection").otherwise("").alias("err_msg"),
        F.lit(1.0).alias("duration"), F.lit(None).cast("timestamp_ntz").alias("executed_at"),
        F.lit(False).alias("timed_out"))
    st, err = L.apply_retry(st, errors.select("query_id", "sql_date", "hash_id", "err_msg", "catalog"), attempts)
    none = F.lit(None)
    return err.select("query_id", F.lit("error").alias("part"), F.col("err_msg").alias("body"), "catalog",
                      none.cast("int").alias("execute_result")).unionByName(
        st.select("query_id", F.lit("statement").alias("part"), F.col("tidb_sql").alias("body"),
                  none.cast("string").alias("catalog"), "execute_result"))


# L11
@register("log_progress", W(_STATEMENTS_SQL + """,
results AS (SELECT sql_type, CASE WHEN coalesce(err_msg, '') <> '' THEN 0 ELSE 1 END AS r, created_at FROM statements WHERE duration > 2)
SELECT sql_type, CAST(count(r) AS BIGINT) AS finished, CAST(sum(CASE WHEN r = 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       round(count(r) / (date_diff('microsecond', min(created_at), max(created_at)) / 1e6), 3) AS rate
FROM results GROUP BY sql_type
"""), "L11")
def log_progress(spark, sf_dir):
    st = _statements(spark, sf_dir)
    res = st.filter(F.col("duration") > 2).select(
        "sql_type", F.when(F.coalesce("err_msg", F.lit("")) != "", 0).otherwise(1).alias("r"), "created_at")
    return L.progress(res, ts="created_at", result="r", by=["sql_type"]).withColumn("rate", F.round("rate", 3))


# Reset results of one date.
@register("log_reset", W(_STATEMENTS_SQL + f"""
SELECT query_id, CASE WHEN sql_date = '{SQL_DATE}' AND execute_result >= 0 THEN NULL ELSE execute_result END AS execute_result,
       CAST(order_id % 8 AS BIGINT) AS bucket
FROM statements
"""), "L12,D5,D8")
def log_reset(spark, sf_dir):
    return L.reset_run(_statements(spark, sf_dir), SQL_DATE, 8).select(
        "query_id", "execute_result", F.col("bucket").cast("bigint").alias("bucket"))


# L12 / D8 on a stored table: only the slices that hold executed rows of the
# date are written again.
@register("log_reset_slices", W(_STATEMENTS_SQL + f""",
after AS (
    SELECT order_id % 8 AS bucket, count(*) AS rows, count(CASE WHEN sql_date = '{SQL_DATE}' THEN NULL ELSE execute_result END) AS results,
           count(*) FILTER (sql_date = '{SQL_DATE}' AND execute_result >= 0) AS reset
    FROM statements GROUP BY 1
)
SELECT CAST(bucket AS INTEGER) AS bucket, CAST(rows AS BIGINT) AS rows, CAST(results AS BIGINT) AS results, reset > 0 AS written FROM after
"""), "L12,D8")
def log_reset_slices(spark, sf_dir):
    path = scratch_path(spark, "statements")
    D.write_slices(_statements(spark, sf_dir).select("query_id", "order_id", "sql_date", "execute_result"), path, "order_id", 8)
    written = L.reset_run_slices(spark, path, SQL_DATE)
    return spark.read.parquet(path).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.count("execute_result").alias("results")).withColumn(
        "written", F.col("bucket").isin(written))


# Block-list of hash ids (those of large error events) disables statements.
@register("id_blocklist", W("""
blocked AS (SELECT DISTINCT hash_id FROM log WHERE event_type = 'error' AND value > 15)
SELECT query_id, hash_id NOT IN (SELECT hash_id FROM blocked) AS enabled FROM log
"""), "P11,D5")
def id_blocklist(spark, sf_dir):
    log = event_log(spark, sf_dir)
    blocked = log.filter((F.col("event_type") == "error") & (F.col("value") > 15)).select("hash_id")
    return P.mark_blocked(log.select("query_id", "hash_id"), blocked, "hash_id").select("query_id", "enabled")


# P11 the other way: the listed statements are dropped.
@register("id_blocklist_drop", W("""
blocked AS (SELECT DISTINCT hash_id FROM log WHERE event_type = 'error' AND value > 15)
SELECT query_id, hash_id FROM log WHERE hash_id NOT IN (SELECT hash_id FROM blocked)
"""), "P11,J8")
def id_blocklist_drop(spark, sf_dir):
    log = event_log(spark, sf_dir)
    blocked = log.filter((F.col("event_type") == "error") & (F.col("value") > 15)).select("hash_id")
    return P.drop_blocked(log.select("query_id", "hash_id"), blocked, "hash_id")


# Dense sequence ids in key order, no global window.
@register("sequence_ids", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS seq_id FROM orders
""", "D6,F18")
def sequence_ids(spark, sf_dir):
    o = tables(spark, sf_dir).orders.select("o_orderkey")
    return with_sequence(o, "seq_id", 1, order_by=["o_orderkey"])


# D6 / F18 across runs: orders arrive in two batches (even and odd keys),
# then the first is replayed.  Rule: the second batch's ids follow the
# first's, the replay has the first's again.
@register("sequence_runs", """
WITH numbered AS (
    SELECT o_orderkey, o_orderkey % 2 AS odd, row_number() OVER (PARTITION BY o_orderkey % 2 ORDER BY o_orderkey) AS n FROM orders
), ids AS (
    SELECT o_orderkey, odd, CAST(n + CASE WHEN odd = 1 THEN (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) ELSE 0 END
                                 + 999 AS BIGINT) AS seq_id FROM numbered
)
SELECT CASE WHEN odd = 0 THEN 1 ELSE 2 END AS run, o_orderkey, seq_id FROM ids
UNION ALL SELECT 3, o_orderkey, seq_id FROM ids WHERE odd = 0
""", "D6,F18")
def sequence_runs(spark, sf_dir):
    o = tables(spark, sf_dir).orders.select("o_orderkey")
    path = scratch_path(spark, "sequence")
    out = None
    for run, (batch, odd) in enumerate((("even", 0), ("odd", 1), ("even", 0)), 1):
        rows = with_stored_sequence(o.filter(F.col("o_orderkey") % 2 == odd), path, "orders", batch,
                                    order_by=["o_orderkey"], start=1000)
        rows = rows.select(F.lit(run).alias("run"), "o_orderkey", "seq_id")
        out = rows if out is None else out.unionByName(rows)
    return out


# A15 merged: sketches of the customers of each month are stored; the years
# and their quarters are answered from the sketches alone, within a bound of
# the exact counts.
@register("sketch_periods", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(quarter(o_orderdate) AS INTEGER) AS qtr,
       count(DISTINCT o_custkey) AS customers, true AS within_bound
FROM orders GROUP BY GROUPING SETS ((1), (1, 2))
""", "A15")
def sketch_periods(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    path = scratch_path(spark, "sketches")
    month = F.trunc("o_orderdate", "month").alias("month")
    A.distinct_sketches(o, [month], "o_custkey").write.parquet(path)
    stored = spark.read.parquet(path).withColumns({"yr": F.year("month"), "qtr": F.quarter("month")})
    quarters = A.merged_distinct(stored, ["yr", "qtr"], "estimate")
    years = A.merged_distinct(stored, ["yr"], "estimate").select("yr", F.lit(None).cast("int").alias("qtr"), "estimate")
    estimates = quarters.unionByName(years).select(F.col("yr").alias("__y"), F.col("qtr").alias("__q"), "estimate")
    days = o.select(F.year("o_orderdate").alias("yr"), F.quarter("o_orderdate").alias("qtr"), "o_custkey").distinct()
    exact = days.groupBy("yr", "qtr").agg(F.count(F.lit(1)).alias("customers")).unionByName(
        days.select("yr", "o_custkey").distinct().groupBy("yr").agg(F.count(F.lit(1)).alias("customers"))
        .select("yr", F.lit(None).cast("int").alias("qtr"), "customers"))
    near = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(2.0), A.SKETCH_BOUND * F.col("customers"))
    return exact.join(estimates, (F.col("yr") == F.col("__y")) & F.col("qtr").eqNullSafe(F.col("__q"))).select(
        "yr", "qtr", "customers", near.alias("within_bound"))


# Approximate distinct users per statement type.  The sketches of two
# engines differ, so the result says whether the estimate lies within four
# standard deviations (20 %) of the exact count.
@register("approx_distinct", """
SELECT event_type, count(DISTINCT user_id) AS users, true AS within_bound FROM events GROUP BY event_type
""", "A15")
def approx_distinct(spark, sf_dir):
    e = tables(spark, sf_dir).events
    approx = e.groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("approx_users"))
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("approx_users") - F.col("users")) <= F.greatest(F.lit(2.0), 0.2 * F.col("users"))
    return exact.join(approx, "event_type").select("event_type", "users", near.alias("within_bound"))
