"""Migration, reconciliation and schema queries on the driver tables.

Two catalog copies are derived from ``customer`` (source and a target that
lost one database, one table per db and differs in columns); the data
check compares ``events`` with a target copy that stores whole seconds,
lost some rows of one table and advanced the version of another.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareshift.functions import typemap as TM
from wareshift.functions.scalars import round_to_second
from wareshift.operators import filters as P
from wareshift.operators import reconcile as R
from wareshift.operators import schema as SC
from wareshift.operators.setops import presence
from wareshift.plans.common import tables
from wareshift.plans.registry import register
from wareshift.session import scratch_path
from wareshift.sources import generations as G
from wareshift.sources import reload as RL

CAT_SQL = """
cat_a AS (
    SELECT DISTINCT 'global_' || lower(c_mktsegment) AS db, 't_' || CAST(c_nationkey AS VARCHAR) AS tbl,
           'c' || CAST(c_custkey % 6 AS VARCHAR) AS col
    FROM customer
),
cat_b AS (
    SELECT DISTINCT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'asset_machinery' ELSE 'global_' || lower(c_mktsegment) END AS db,
           't_' || CAST(CASE WHEN c_nationkey = 24 THEN 99 ELSE c_nationkey END AS VARCHAR) AS tbl,
           'c' || CAST(c_custkey % 7 AS VARCHAR) AS col
    FROM customer
)"""


def catalogs(spark, sf_dir):
    c = tables(spark, sf_dir).customer
    a = c.select(F.concat(F.lit("global_"), F.lower("c_mktsegment")).alias("db"),
                 F.concat(F.lit("t_"), F.col("c_nationkey").cast("string")).alias("tbl"),
                 F.concat(F.lit("c"), (F.col("c_custkey") % 6).cast("string")).alias("col")).distinct()
    b = c.select(
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("asset_machinery"))
        .otherwise(F.concat(F.lit("global_"), F.lower("c_mktsegment"))).alias("db"),
        F.concat(F.lit("t_"), F.when(F.col("c_nationkey") == 24, F.lit(99)).otherwise(F.col("c_nationkey")).cast("string")).alias("tbl"),
        F.concat(F.lit("c"), (F.col("c_custkey") % 7).cast("string")).alias("col")).distinct()
    return a, b


def _side_sql(a, b, keys):
    on = " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)
    sel = ", ".join(f"coalesce({a}.{k}, {b}.{k}) AS {k}" for k in keys)
    k0 = keys[-1]
    return (f"SELECT {sel}, CASE WHEN {a}.{k0} IS NOT NULL AND {b}.{k0} IS NOT NULL THEN 'both' "
            f"WHEN {a}.{k0} IS NOT NULL THEN 'source_only' ELSE 'target_only' END AS side "
            f"FROM {a} FULL JOIN {b} ON {on}")


@register("diff_databases", f"""
WITH {CAT_SQL},
da AS (SELECT DISTINCT db FROM cat_a), db_ AS (SELECT DISTINCT db FROM cat_b)
{_side_sql('da', 'db_', ['db'])}
""", "R1,U5")
def diff_databases(spark, sf_dir):
    a, b = catalogs(spark, sf_dir)
    return R.diff_databases(a.select("db").distinct(), b.select("db").distinct())


@register("diff_tables", f"""
WITH {CAT_SQL},
dbs AS (SELECT db FROM cat_a INTERSECT SELECT db FROM cat_b),
ta AS (SELECT DISTINCT db, tbl FROM cat_a WHERE db IN (SELECT db FROM dbs)),
tb AS (SELECT DISTINCT db, tbl FROM cat_b WHERE db IN (SELECT db FROM dbs)),
p AS ({_side_sql('ta', 'tb', ['db', 'tbl'])})
SELECT db,
       CAST(sum(CASE WHEN side = 'source_only' THEN 1 ELSE 0 END) AS BIGINT) AS source_only,
       CAST(sum(CASE WHEN side = 'target_only' THEN 1 ELSE 0 END) AS BIGINT) AS target_only,
       CAST(sum(CASE WHEN side = 'both' THEN 1 ELSE 0 END) AS BIGINT) AS common,
       coalesce(string_agg(CASE WHEN side = 'source_only' THEN tbl END, ',' ORDER BY CASE WHEN side = 'source_only' THEN tbl END), '') AS missing_in_target
FROM p GROUP BY db
""", "R2,U4")
def diff_tables(spark, sf_dir):
    a, b = catalogs(spark, sf_dir)
    return R.diff_tables(a.select("db", "tbl").distinct(), b.select("db", "tbl").distinct())


_DIFF_COLUMNS_SQL = f"""
common AS (SELECT DISTINCT db, tbl FROM cat_a INTERSECT SELECT DISTINCT db, tbl FROM cat_b),
ca AS (SELECT * FROM cat_a WHERE (db, tbl) IN (SELECT (db, tbl) FROM common)),
cb AS (SELECT * FROM cat_b WHERE (db, tbl) IN (SELECT (db, tbl) FROM common)),
p AS ({_side_sql('ca', 'cb', ['db', 'tbl', 'col'])}),
diff_cols AS (
    SELECT db, tbl,
           CAST(sum(CASE WHEN side <> 'target_only' THEN 1 ELSE 0 END) AS BIGINT) AS source_cols,
           CAST(sum(CASE WHEN side <> 'source_only' THEN 1 ELSE 0 END) AS BIGINT) AS target_cols,
           coalesce(string_agg(CASE WHEN side = 'source_only' THEN col END, ',' ORDER BY CASE WHEN side = 'source_only' THEN col END), '') AS source_only,
           coalesce(string_agg(CASE WHEN side = 'target_only' THEN col END, ',' ORDER BY CASE WHEN side = 'target_only' THEN col END), '') AS target_only
    FROM p GROUP BY db, tbl
)"""


@register("diff_columns", f"""
WITH {CAT_SQL}, {_DIFF_COLUMNS_SQL}
SELECT *, source_only = '' AND target_only = '' AS schema_match FROM diff_cols
""", "R3")
def diff_columns(spark, sf_dir):
    a, b = catalogs(spark, sf_dir)
    return R.diff_columns(a, b)


@register("presence_full", f"""
WITH {CAT_SQL},
ta AS (SELECT DISTINCT db, tbl FROM cat_a), tb AS (SELECT DISTINCT db, tbl FROM cat_b)
{_side_sql('ta', 'tb', ['db', 'tbl'])}
""", "J16")
def presence_full(spark, sf_dir):
    a, b = catalogs(spark, sf_dir)
    return presence(a.select("db", "tbl"), b.select("db", "tbl"), ["db", "tbl"])


_MISMATCH_SQL = f"""
WITH {CAT_SQL}, {_DIFF_COLUMNS_SQL},
report AS (
    SELECT DISTINCT db || '.' || tbl AS table_name FROM (
        SELECT db, tbl FROM cat_a WHERE db NOT IN (SELECT db FROM cat_b)
        UNION ALL
        SELECT DISTINCT a.db, a.tbl FROM cat_a a LEFT JOIN (SELECT DISTINCT db, tbl FROM cat_b) b
          ON a.db = b.db AND a.tbl = b.tbl WHERE b.tbl IS NULL
        UNION ALL
        SELECT db, tbl FROM diff_cols WHERE NOT (source_only = '' AND target_only = '')
    ) u
)"""


def _mismatch(spark, sf_dir):
    a, b = catalogs(spark, sf_dir)
    cols = R.diff_columns(a, b)
    ta, tb = a.select("db", "tbl").distinct(), b.select("db", "tbl").distinct()
    return a, R.mismatch_report(ta, tb, columns_report=cols)


@register("mismatch_report", _MISMATCH_SQL + "\nSELECT table_name FROM report ORDER BY table_name", "R6,U6,T1")
def mismatch_report(spark, sf_dir):
    return _mismatch(spark, sf_dir)[1]


@register("reload_join", _MISMATCH_SQL + """
SELECT a.db, a.tbl, a.col FROM cat_a a WHERE a.db || '.' || a.tbl IN (SELECT table_name FROM report)
""", "J17,R14")
def reload_join(spark, sf_dir):
    a, report = _mismatch(spark, sf_dir)
    return R.reload_plan(report, a)


# ---------------------------------------------------------------------------
# R14 carried out: a target that lost rows of customer, holds an older
# version of part and lacks nation is compared with the source; the listed
# tables are exported, loaded and compared again.  Rule: exactly those three
# are listed and loaded, and afterwards all four agree with the source.
_RELOAD_SQL = """
WITH src AS (
    SELECT 'dim' AS db, 'customer' AS tbl, c_custkey AS id, c_custkey % 5 AS version, c_name AS name, c_acctbal AS amount FROM customer
    UNION ALL SELECT 'dim', 'supplier', s_suppkey, s_suppkey % 5, s_name, s_acctbal FROM supplier
    UNION ALL SELECT 'item', 'part', p_partkey, p_partkey % 5, p_name, p_retailprice FROM part
    UNION ALL SELECT 'geo', 'nation', n_nationkey, n_nationkey % 5, n_name, NULL FROM nation
)
SELECT db, tbl, tbl <> 'supplier' AS listed, CASE WHEN tbl <> 'supplier' THEN 'loaded' END AS state,
       CAST(count(*) AS BIGINT) AS rows, max(id) AS max_id, max(version) AS max_version, sum(CAST(amount AS DECIMAL(15,2))) AS amount,
       CAST(sum(length(name)) AS BIGINT) AS name_chars, true AS agrees
FROM src GROUP BY db, tbl
"""
_RELOAD_COLUMNS = ["id", "version", "name", "amount"]


def _reload_sources(spark, sf_dir):
    t = tables(spark, sf_dir)

    def of(frame, key, name, amount):
        key = F.col(key).cast("bigint")
        return frame.select(key.alias("id"), (key % 5).alias("version"), F.col(name).alias("name"),
                            (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"))

    return {("dim", "customer"): of(t.customer, "c_custkey", "c_name", "c_acctbal"),
            ("dim", "supplier"): of(t.supplier, "s_suppkey", "s_name", "s_acctbal"),
            ("item", "part"): of(t.part, "p_partkey", "p_name", "p_retailprice"),
            ("geo", "nation"): of(t.nation, "n_nationkey", "n_name", None)}


def _tagged(frames):
    out = None
    for (db, tbl), df in frames.items():
        df = df.select(F.lit(db).alias("db"), F.lit(tbl).alias("tbl"), *_RELOAD_COLUMNS)
        out = df if out is None else out.unionByName(df)
    return out


@register("reload_mismatch", _RELOAD_SQL, "R14,R4,R5,R6,S2,S3,S4,J17")
def reload_mismatch(spark, sf_dir):
    src = _reload_sources(spark, sf_dir)
    root = scratch_path(spark, "reload")
    old = {("dim", "customer"): src["dim", "customer"].filter(F.col("id") % 10 != 7), ("dim", "supplier"): src["dim", "supplier"],
           ("item", "part"): src["item", "part"].withColumn("version", F.greatest(F.col("version") - 1, F.lit(0)))}
    for (db, tbl), df in old.items():
        G.replace(spark, RL.target_path(f"{root}/target", db, tbl), lambda p, df=df: df.write.mode("overwrite").parquet(p))

    def compared():
        target = {k: RL.read_target(spark, f"{root}/target", *k) for k in src}
        there = {k: df for k, df in target.items() if df is not None}
        return there, R.compare_counts_max(_tagged(src), _tagged(there), ["db", "tbl"], ["id", "version"], [])

    names = spark.createDataFrame(list(src), "db string, tbl string")
    there, data = compared()
    report = R.mismatch_report(names, spark.createDataFrame(list(there), "db string, tbl string"), data_report=data)
    schema_cols = names.crossJoin(F.broadcast(spark.createDataFrame(list(enumerate(_RELOAD_COLUMNS)), "pos int, name string").limit(99)))
    done = RL.reload_tables(report, schema_cols, lambda db, tbl: src[db, tbl], f"{root}/export", f"{root}/target",
                            f"{root}/quarantine", f"{root}/journal", "run-1")
    there, after = compared()
    state = done.select(F.split("table_name", "\\.")[0].alias("db"), F.split("table_name", "\\.")[1].alias("tbl"), "state")
    facts = _tagged(there).groupBy("db", "tbl").agg(
        F.count(F.lit(1)).alias("rows"), F.max("id").alias("max_id"), F.max("version").alias("max_version"),
        F.sum(F.col("amount").cast("decimal(15,2)")).alias("amount"), F.sum(F.length("name")).alias("name_chars"))
    return (facts.join(after.select("db", "tbl", F.col("data_match").alias("agrees")), ["db", "tbl"])
            .join(state, ["db", "tbl"], "left")
            .select("db", "tbl", F.col("state").isNotNull().alias("listed"), "state", "rows", "max_id", "max_version",
                    "amount", "name_chars", "agrees"))


# ---------------------------------------------------------------------------
# Counts and maxima per table of two copies.
def _round_sec_sql(ts: str) -> str:
    frac = f"(microsecond({ts}) % 1000000)"
    return (f"(CASE WHEN (CASE WHEN year({ts}) >= 1970 THEN {frac} >= 500000 ELSE {frac} > 500000 END) "
            f"THEN date_trunc('second', {ts}) + INTERVAL 1 SECOND ELSE date_trunc('second', {ts}) END)")


@register("compare_counts_max", f"""
WITH src AS (
    SELECT event_type AS tbl, CAST(count(*) AS BIGINT) AS source_cnt, max(event_id) AS source_max_id,
           max(user_id) AS source_max_version, max({_round_sec_sql('ts')}) AS source_max_updated_at
    FROM events GROUP BY event_type
),
tgt AS (
    SELECT event_type AS tbl, CAST(count(*) AS BIGINT) AS target_cnt, max(event_id) AS target_max_id,
           max(user_id + CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS target_max_version,
           max({_round_sec_sql('ts')}) AS target_max_updated_at
    FROM events WHERE NOT (event_type = 'signup' AND value > 19.5) GROUP BY event_type
)
SELECT coalesce(s.tbl, t.tbl) AS tbl, s.source_cnt, s.source_max_id, s.source_max_version, s.source_max_updated_at,
       t.target_cnt, t.target_max_id, t.target_max_version, t.target_max_updated_at,
       coalesce(s.source_cnt = t.target_cnt, false) AS count_match,
       coalesce(s.source_cnt = t.target_cnt, false)
         AND s.source_max_id IS NOT DISTINCT FROM t.target_max_id
         AND s.source_max_version IS NOT DISTINCT FROM t.target_max_version
         AND s.source_max_updated_at IS NOT DISTINCT FROM t.target_max_updated_at AS data_match
FROM src s FULL JOIN tgt t ON s.tbl = t.tbl
""", "R4,R5,A14,F14,J16")
def compare_counts_max(spark, sf_dir):
    e = tables(spark, sf_dir).events
    src = e.select(F.col("event_type").alias("tbl"), F.col("event_id").alias("id"),
                   F.col("user_id").alias("version"), F.col("ts").alias("updated_at"))
    tgt = e.filter(~((F.col("event_type") == "signup") & (F.col("value") > 19.5))).select(
        F.col("event_type").alias("tbl"), F.col("event_id").alias("id"),
        (F.col("user_id") + F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("version"),
        round_to_second("ts").alias("updated_at"))
    return R.compare_counts_max(src, tgt, "tbl")


# R4-R6 over two databases that hold tables of the same names: counts and
# maxima per (db, tbl), and the report of the tables that fail them.
_TWO_DBS_SQL = """
WITH src AS (
    SELECT 'db' || CAST(user_id % 2 AS VARCHAR) AS db, event_type AS tbl, count(*) AS n, max(event_id) AS id
    FROM events GROUP BY 1, 2
), tgt AS (
    SELECT 'db' || CAST(user_id % 2 AS VARCHAR) AS db, event_type AS tbl, count(*) AS n,
           max(event_id + CASE WHEN event_type = 'click' AND user_id % 2 = 1 THEN 1 ELSE 0 END) AS id
    FROM events WHERE NOT (event_type = 'signup' AND user_id % 2 = 0) AND NOT (event_type = 'view' AND event_id % 5 = 0)
    GROUP BY 1, 2
)"""


def _two_dbs(spark, sf_dir):
    e = tables(spark, sf_dir).events
    db = F.concat(F.lit("db"), (F.col("user_id") % 2).cast("string")).alias("db")
    kind, odd = F.col("event_type"), F.col("user_id") % 2 == 1
    src = e.select(db, kind.alias("tbl"), F.col("event_id").alias("id"))
    tgt = e.filter(~((kind == "signup") & ~odd) & ~((kind == "view") & (F.col("event_id") % 5 == 0))).select(
        db, kind.alias("tbl"), (F.col("event_id") + F.when((kind == "click") & odd, 1).otherwise(0)).alias("id"))
    return src, tgt, R.compare_counts_max(src, tgt, ["db", "tbl"], ["id"], [])


@register("compare_counts_max_dbs", _TWO_DBS_SQL + """
SELECT coalesce(s.db, t.db) AS db, coalesce(s.tbl, t.tbl) AS tbl, coalesce(s.n = t.n, false) AS count_match,
       coalesce(s.n = t.n, false) AND s.id IS NOT DISTINCT FROM t.id AS data_match
FROM src s FULL JOIN tgt t ON s.db = t.db AND s.tbl = t.tbl
""", "R4,R5")
def compare_counts_max_dbs(spark, sf_dir):
    return _two_dbs(spark, sf_dir)[2].select("db", "tbl", "count_match", "data_match")


@register("mismatch_data", _TWO_DBS_SQL + """
SELECT s.db || '.' || s.tbl AS table_name FROM src s LEFT JOIN tgt t ON s.db = t.db AND s.tbl = t.tbl
WHERE t.n IS NULL OR s.n <> t.n OR s.id <> t.id
""", "R6,R4,R5")
def mismatch_data(spark, sf_dir):
    src, tgt, data = _two_dbs(spark, sf_dir)
    names = ["db", "tbl"]
    return R.mismatch_report(src.select(*names).distinct(), tgt.select(*names).distinct(), data_report=data)


# ---------------------------------------------------------------------------
# Schema records of real tables: types from the table schema, string
# lengths profiled from the data.
SCHEMA_META = {
    "customer": (["c_custkey"], [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                                 ("c_acctbal", "double"), ("c_mktsegment", "string")]),
    "part": (["p_partkey"], [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
                             ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]),
    "orders": (["o_orderkey"], [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                                ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")]),
    "documents": (["doc_id"], [("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
                               ("source", "string"), ("n_chars", "bigint")]),
}
SCHEMA_DEFAULTS = {"c_mktsegment": "HOUSEHOLD", "c_acctbal": "0", "o_orderdate": "0",
                   "o_orderstatus": "O", "lang": "en", "p_size": "1"}
SCHEMA_DB = "global_shop"
# Type-list rows covering the closed type list and the bucket borders.
EXTRA_TYPES = [
    ("e_small", "smallint", 0), ("e_float", "float", 0), ("e_dec", "decimal(28,3)", 0),
    ("e_tiny", "tinyint", 0), ("e_flag", "boolean", 0), ("e_date", "date", 0),
    ("s50", "string", 50), ("s51", "string", 51), ("s255", "string", 255), ("s256", "string", 256),
    ("s2000", "string", 2000), ("s2001", "string", 2001), ("s16383", "string", 16383),
    ("s16384", "string", 16384), ("s65535", "string", 65535), ("s65536", "string", 65536),
]


def schema_cols(spark, sf_dir):
    t = tables(spark, sf_dir)
    out = None
    for name, (keys, cols) in SCHEMA_META.items():
        df = getattr(t, name)
        got = [(c, SC.source_type(ty)) for c, ty in df.dtypes]
        if got != cols:
            raise ValueError(f"unexpected schema for {name}: {got}")
        part = SC.extract_schema(spark, df, SCHEMA_DB, name, keys, SCHEMA_DEFAULTS)
        out = part if out is None else out.unionByName(part)
    return out


def extra_cols(spark):
    return spark.createDataFrame(
        [(SCHEMA_DB, "extras", i + 1, n, ty, ln, "true", "", False) for i, (n, ty, ln) in enumerate(EXTRA_TYPES)],
        "db string, tbl string, pos int, name string, type string, len bigint, nullable string, default_value string, is_key boolean")


def _schema_sql() -> str:
    parts = []
    for name, (keys, cols) in SCHEMA_META.items():
        for i, (c, ty) in enumerate(cols):
            ln = f"(SELECT CAST(coalesce(max(strlen({c})), 0) AS BIGINT) FROM {name})" if ty == "string" else "CAST(0 AS BIGINT)"
            nullable = "false" if c in keys else "true"
            parts.append(f"SELECT '{SCHEMA_DB}' AS db, '{name}' AS tbl, {i + 1} AS pos, '{c}' AS name, '{ty}' AS type, "
                         f"{ln} AS len, '{nullable}' AS nullable, '{SCHEMA_DEFAULTS.get(c, '')}' AS default_value, "
                         f"{'true' if c in keys else 'false'} AS is_key")
    return "schema_cols AS (\n    " + "\n    UNION ALL ".join(parts) + "\n)"


def _extras_sql() -> str:
    rows = ", ".join(f"('{SCHEMA_DB}', 'extras', {i + 1}, '{n}', '{ty}', CAST({ln} AS BIGINT), 'true', '', false)"
                     for i, (n, ty, ln) in enumerate(EXTRA_TYPES))
    return (f"extras AS (SELECT * FROM (VALUES {rows}) "
            "v(db, tbl, pos, name, type, len, nullable, default_value, is_key))")


def _bucket_sql(n: str) -> str:
    whens = " ".join(f"WHEN {n} <= {b} THEN {b}" for b in TM.LENGTH_BUCKETS)
    return f"CAST(CASE {whens} ELSE {TM.LONGTEXT_LENGTH} END AS BIGINT)"


def _map_type_sql(ty: str, n: str) -> str:
    b = _bucket_sql(n)
    simple = " ".join(f"WHEN lower(trim({ty})) = '{s}' THEN '{d}'" for s, d in TM.SIMPLE_TYPES.items())
    return (f"CASE WHEN lower(trim({ty})) = 'string' THEN "
            f"(CASE WHEN {b} <= 16383 THEN 'varchar(' || CAST({b} AS VARCHAR) || ') character set utf8mb4' "
            f"WHEN {b} <= 65535 THEN 'text(' || CAST({b} AS VARCHAR) || ') character set utf8mb4' "
            f"ELSE 'longtext character set utf8mb4' END) {simple} "
            f"WHEN starts_with(lower(trim({ty})), 'decimal') THEN lower(trim({ty})) END")


def _map_default_sql(tt: str, dv: str) -> str:
    d = f"coalesce({dv}, '')"
    return (f"CASE WHEN starts_with({tt}, 'varchar') AND {d} <> '' THEN '\"' || {d} || '\"' "
            f"WHEN {tt} = 'datetime' THEN (CASE WHEN {d} = '0' THEN '\"1970-01-01\"' ELSE '' END) "
            f"WHEN starts_with({tt}, 'text') THEN '' ELSE {d} END")


_SCHEMA_WITH = f"WITH {_schema_sql()}, {_extras_sql()},\nall_cols AS (SELECT * FROM schema_cols UNION ALL SELECT * FROM extras)"


@register("profile_lengths", """
SELECT 'customer' AS tbl, 'c_name' AS name, CAST(coalesce(max(strlen(c_name)), 0) AS BIGINT) AS len FROM customer
UNION ALL SELECT 'customer', 'c_mktsegment', CAST(coalesce(max(strlen(c_mktsegment)), 0) AS BIGINT) FROM customer
UNION ALL SELECT 'part', 'p_name', CAST(coalesce(max(strlen(p_name)), 0) AS BIGINT) FROM part
UNION ALL SELECT 'part', 'p_brand', CAST(coalesce(max(strlen(p_brand)), 0) AS BIGINT) FROM part
UNION ALL SELECT 'part', 'p_type', CAST(coalesce(max(strlen(p_type)), 0) AS BIGINT) FROM part
UNION ALL SELECT 'documents', 'text', CAST(coalesce(max(strlen(text)), 0) AS BIGINT) FROM documents
UNION ALL SELECT 'documents', 'lang', CAST(coalesce(max(strlen(lang)), 0) AS BIGINT) FROM documents
UNION ALL SELECT 'documents', 'source', CAST(coalesce(max(strlen(source)), 0) AS BIGINT) FROM documents
""", "R8,A13")
def profile_lengths(spark, sf_dir):
    t = tables(spark, sf_dir)
    out = None
    for name in ("customer", "part", "documents"):
        p = SC.profile_string_lengths(getattr(t, name), name)
        out = p if out is None else out.unionByName(p)
    return out


@register("length_bucket", _SCHEMA_WITH + f"""
SELECT tbl, name, len, {_bucket_sql('len')} AS bucket FROM all_cols WHERE type = 'string'
""", "R9")
def length_bucket(spark, sf_dir):
    c = schema_cols(spark, sf_dir).unionByName(extra_cols(spark))
    return c.filter(F.col("type") == "string").select("tbl", "name", "len", TM.length_bucket("len").alias("bucket"))


@register("map_types", _SCHEMA_WITH + f"""
SELECT tbl, name, type, len, {_map_type_sql('type', 'len')} AS target_type,
       CASE WHEN ({_map_type_sql('type', 'len')}) IS NULL THEN 'unprocessed type ' || type END AS type_error
FROM all_cols
""", "R10")
def map_types(spark, sf_dir):
    c = SC.typed_columns(schema_cols(spark, sf_dir).unionByName(extra_cols(spark)))
    return c.select("tbl", "name", "type", "len", "target_type", "type_error")


@register("map_defaults", _SCHEMA_WITH + f""",
typed AS (SELECT *, {_map_type_sql('type', 'len')} AS target_type FROM all_cols)
SELECT tbl, name, target_type, default_value, {_map_default_sql('target_type', 'default_value')} AS target_default
FROM typed
""", "R11")
def map_defaults(spark, sf_dir):
    c = SC.typed_columns(schema_cols(spark, sf_dir).unionByName(extra_cols(spark)))
    return c.select("tbl", "name", "target_type", "default_value", "target_default")


@register("render_ddl", f"WITH {_schema_sql()}" + f""",
typed AS (SELECT *, {_map_type_sql('type', 'len')} AS target_type FROM schema_cols),
lines AS (
    SELECT db, tbl, pos, is_key, name,
           printf('\t%-25s%-40s%-15s%-20s,', '`' || name || '`', coalesce(target_type, ''),
                  CASE WHEN nullable = 'true' THEN 'null' ELSE 'not null' END,
                  CASE WHEN coalesce({_map_default_sql('target_type', 'default_value')}, '') = '' THEN ''
                       ELSE 'default ' || {_map_default_sql('target_type', 'default_value')} END) AS line
    FROM typed
),
g AS (
    SELECT db, tbl, string_agg(line, chr(10) ORDER BY pos) AS body,
           coalesce(string_agg(CASE WHEN is_key THEN '`' || name || '`' END, ',' ORDER BY pos), '') AS pk
    FROM lines GROUP BY db, tbl
)
SELECT db, tbl,
       'create table `' || db || '`.`' || tbl || '`' || chr(10) || '(' || chr(10) ||
       CASE WHEN pk <> '' THEN body || chr(10) || printf('\tPRIMARY KEY (%s) /*T![clustered_index] CLUSTERED */', pk)
            ELSE regexp_replace(body, ',+$', '') END || chr(10) || ')' AS ddl
FROM g
""", "R12,R7")
def render_ddl(spark, sf_dir):
    return SC.render_ddl(schema_cols(spark, sf_dir))


@register("minimal_key", """
SELECT 'lineitem' AS tbl, 'l_orderkey,l_linenumber' AS candidate,
       NOT EXISTS (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS candidate_unique,
       CASE WHEN EXISTS (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
            THEN 'l_orderkey,l_linenumber,l_partkey,l_suppkey' ELSE 'l_orderkey,l_linenumber' END AS chosen
UNION ALL
SELECT 'orders', 'o_custkey,o_orderkey',
       NOT EXISTS (SELECT 1 FROM orders GROUP BY o_custkey, o_orderkey HAVING count(*) > 1),
       CASE WHEN EXISTS (SELECT 1 FROM orders GROUP BY o_custkey, o_orderkey HAVING count(*) > 1)
            THEN 'o_custkey,o_orderkey,o_orderdate' ELSE 'o_custkey,o_orderkey' END
""", "R13,A7")
def minimal_key(spark, sf_dir):
    t = tables(spark, sf_dir)
    a = SC.minimal_key(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                       tenant="l_orderkey", id_col="l_linenumber")
    b = SC.minimal_key(t.orders, "orders", ["o_custkey", "o_orderkey", "o_orderdate"],
                       tenant="o_custkey", id_col="o_orderkey")
    return a.unionByName(b)


# Several candidate keys of one table, tested in one scan.
@register("candidate_keys", """
SELECT 'l_orderkey' AS candidate, count(DISTINCT l_orderkey) = count(*) AS is_unique FROM lineitem
UNION ALL SELECT 'l_partkey,l_suppkey', (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)) = count(*) FROM lineitem
UNION ALL SELECT 'l_orderkey,l_linenumber', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) = count(*) FROM lineitem
UNION ALL SELECT 'l_orderkey,l_partkey', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) = count(*) FROM lineitem
UNION ALL SELECT 'l_orderkey,l_partkey,l_suppkey,l_linenumber',
                 (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem)) = count(*) FROM lineitem
""", "R13,A7,A15")
def candidate_keys(spark, sf_dir):
    li = tables(spark, sf_dir).lineitem
    candidates = [["l_orderkey"], ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"],
                  ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]]
    found = SC.unique_keys(li, candidates)
    return spark.createDataFrame([(",".join(c), u) for c, u in zip(candidates, found)], "candidate string, is_unique boolean")


# ---------------------------------------------------------------------------
# database/table name filters and boolean export form.
_DB_NAMES_SQL = """
SELECT DISTINCT CASE c_custkey % 8
    WHEN 0 THEN 'global_' || lower(c_mktsegment)
    WHEN 1 THEN 'asset_n' || CAST(c_nationkey AS VARCHAR)
    WHEN 2 THEN 'n' || CAST(c_nationkey AS VARCHAR) || '_custom'
    WHEN 3 THEN '___tmp_' || CAST(c_nationkey AS VARCHAR)
    WHEN 4 THEN 'global_x' || CAST(c_nationkey AS VARCHAR) || '_text'
    WHEN 5 THEN 'public_data'
    WHEN 6 THEN 'dp_stat'
    ELSE 'other_' || CAST(c_nationkey AS VARCHAR) END AS db
FROM customer"""


@register("db_filter", f"""
SELECT db FROM ({_DB_NAMES_SQL}) x
WHERE (starts_with(db, 'global_') OR starts_with(db, 'asset_') OR ends_with(db, '_custom') OR db IN ('public_data', 'dp_stat'))
  AND NOT starts_with(db, '___') AND NOT ends_with(db, '_text')
""", "P1")
def db_filter(spark, sf_dir):
    c = tables(spark, sf_dir).customer
    k = F.col("c_custkey") % 8
    n = F.col("c_nationkey").cast("string")
    db = (F.when(k == 0, F.concat(F.lit("global_"), F.lower("c_mktsegment")))
          .when(k == 1, F.concat(F.lit("asset_n"), n))
          .when(k == 2, F.concat(F.lit("n"), n, F.lit("_custom")))
          .when(k == 3, F.concat(F.lit("___tmp_"), n))
          .when(k == 4, F.concat(F.lit("global_x"), n, F.lit("_text")))
          .when(k == 5, F.lit("public_data")).when(k == 6, F.lit("dp_stat"))
          .otherwise(F.concat(F.lit("other_"), n)))
    return P.business_dbs(c.select(db.alias("db")).distinct())


@register("table_filter", """
SELECT db, tbl FROM (
    SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN 'dp_stat' ELSE 'global_parts' END AS db,
           CASE p_partkey % 4 WHEN 0 THEN lower(p_type) || '_history'
                              WHEN 1 THEN 'impala_query_log_' || CAST(p_size AS VARCHAR)
                              WHEN 2 THEN 'history_' || lower(p_type)
                              ELSE lower(p_type) || '_' || CAST(p_size AS VARCHAR) END AS tbl
    FROM part
) x
WHERE NOT (db = 'dp_stat' AND (ends_with(tbl, '_history') OR starts_with(tbl, 'impala_query_log')))
""", "P2")
def table_filter(spark, sf_dir):
    p = tables(spark, sf_dir).part
    k = F.col("p_partkey") % 4
    names = p.select(
        F.when(F.col("p_partkey") % 3 == 0, F.lit("dp_stat")).otherwise(F.lit("global_parts")).alias("db"),
        F.when(k == 0, F.concat(F.lower("p_type"), F.lit("_history")))
        .when(k == 1, F.concat(F.lit("impala_query_log_"), F.col("p_size").cast("string")))
        .when(k == 2, F.concat(F.lit("history_"), F.lower("p_type")))
        .otherwise(F.concat(F.lower("p_type"), F.lit("_"), F.col("p_size").cast("string"))).alias("tbl"),
    ).distinct()
    return P.skip_tables(names)


@register("bool_to_int", """
SELECT c_custkey, CAST(c_acctbal > 5000 AS INTEGER) AS rich, CAST(c_acctbal < 0 AS INTEGER) AS negative, c_name
FROM customer
""", "P3,P5")
def bool_to_int(spark, sf_dir):
    c = tables(spark, sf_dir).customer.select(
        "c_name", "c_custkey", (F.col("c_acctbal") > 5000).alias("rich"), (F.col("c_acctbal") < 0).alias("negative"))
    return P.key_first(P.bool_to_int(c), "c_custkey")
