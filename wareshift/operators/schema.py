"""Schema extraction, length profiling, type mapping and DDL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareshift.functions.typemap import map_default, map_type
from wareshift.operators.aggregates import max_lengths

# Columns that are often too short when profiled, with the
# length to use instead (no profiling for them).
FIXED_LENGTHS = {"excel_task_id": 1000, "remark": 2000, "progress_name": 2000}
# In row-store-less (parquet) tables the tenant column gets
# length 50 and moves to position 1.
TENANT_COLUMN = "tenant"
TENANT_LENGTH = 50

# Spark type name -> source type name of the schema records.
SPARK_TO_SOURCE = {
    "bigint": "bigint", "int": "int", "tinyint": "tinyint", "smallint": "smallint",
    "double": "double", "float": "float", "string": "string", "boolean": "boolean",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "date": "date",
}

# Primary key clause of the target dialect.
PK_TEMPLATE = "\tPRIMARY KEY (%s) /*T![clustered_index] CLUSTERED */"
# Column line layout (name 25, type 40, null 15, default 20).
LINE_FORMAT = "\t%-25s%-40s%-15s%-20s,"


def source_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type
    return SPARK_TO_SOURCE.get(spark_type, spark_type)


def profile_string_lengths(df: DataFrame, table: str, kind: str = "kudu",
                           fixed: Mapping[str, int] = FIXED_LENGTHS) -> DataFrame:
    """(tbl, name, len) for every string column: fixed names get their
    fixed length, the others the max byte length found in the data (one
    aggregate over all of them).  In parquet tables ``tenant`` is fixed 50."""
    fixed = dict(fixed)
    if kind == "parquet":
        fixed[TENANT_COLUMN] = TENANT_LENGTH
    strings = [c for c, t in df.dtypes if t == "string"]
    profiled = [c for c in strings if c not in fixed]
    rows = []
    if profiled:
        wide = max_lengths(df, profiled)
        stack = ", ".join(f"'{c}', `{c}`" for c in profiled)
        rows.append(wide.select(F.expr(f"stack({len(profiled)}, {stack}) as (name, len)")))
    spark = df.sparkSession
    fixed_rows = [(c, int(fixed[c])) for c in strings if c in fixed]
    if fixed_rows:
        rows.append(spark.createDataFrame(fixed_rows, "name string, len bigint"))
    if not rows:
        return spark.createDataFrame([], "tbl string, name string, len bigint")
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select(F.lit(table).alias("tbl"), "name", F.col("len").cast("bigint").alias("len"))


def extract_schema(spark: SparkSession, df: DataFrame, db: str, table: str, keys: Sequence[str] = (),
                   defaults: Mapping[str, str] | None = None, kind: str = "kudu") -> DataFrame:
    """One row per column: (db, tbl, pos, name, type, len, nullable,
    default_value, is_key); lengths of string columns come from
    :func:`profile_string_lengths`, other columns have len 0.  Parquet
    tables have no keys and their tenant column is moved first (P5)."""
    defaults = dict(defaults or {})
    names = [c for c, _ in df.dtypes]
    if kind == "parquet" and TENANT_COLUMN in names:
        names = [TENANT_COLUMN] + [c for c in names if c != TENANT_COLUMN]
        keys = ()
    types = dict(df.dtypes)
    meta = [
        (db, table, i + 1, c, source_type(types[c]), "false" if c in keys else "true",
         defaults.get(c, ""), c in keys)
        for i, c in enumerate(names)
    ]
    cols = spark.createDataFrame(
        meta, "db string, tbl string, pos int, name string, type string, nullable string, default_value string, is_key boolean")
    lens = profile_string_lengths(df, table, kind).select("name", "len")
    return cols.join(F.broadcast(lens), "name", "left").select(
        "db", "tbl", "pos", "name", "type", F.coalesce("len", F.lit(0)).cast("bigint").alias("len"),
        "nullable", "default_value", "is_key")


def typed_columns(schema_cols: DataFrame) -> DataFrame:
    """R10/R11 over schema rows: target type, type error and target default."""
    tt = map_type("type", "len")
    return schema_cols.withColumn("target_type", tt).withColumn(
        "type_error", F.when(tt.isNull(), F.concat(F.lit("unprocessed type "), F.col("type")))
    ).withColumn("target_default", map_default("target_type", "default_value"))


def render_ddl(schema_cols: DataFrame) -> DataFrame:
    """One CREATE TABLE text per table, columns in position order.

    Grouping is per table and a table has a bounded number of columns, so
    the collected list per group stays small."""
    t = typed_columns(schema_cols)
    null_stmt = F.when(F.col("nullable") == "true", F.lit("null")).otherwise(F.lit("not null"))
    default_stmt = F.when(F.coalesce(F.col("target_default"), F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit("default "), F.col("target_default")))
    line = F.format_string(LINE_FORMAT, F.concat(F.lit("`"), F.col("name"), F.lit("`")),
                           F.coalesce(F.col("target_type"), F.lit("")), null_stmt, default_stmt)
    lines = t.select("db", "tbl", "pos", "is_key", "name", line.alias("line"))
    g = lines.groupBy("db", "tbl").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("ls"),
        F.array_sort(F.collect_list(F.when(F.col("is_key"), F.struct("pos", F.concat(F.lit("`"), F.col("name"), F.lit("`")).alias("k"))))).alias("ks"),
    )
    body = F.array_join(F.transform("ls", lambda x: x["line"]), "\n")
    pk = F.array_join(F.transform("ks", lambda x: x["k"]), ",")
    full = F.when(pk != "", F.concat(body, F.lit("\n"), F.format_string(PK_TEMPLATE, pk))).otherwise(
        F.regexp_replace(body, ",+$", ""))
    ddl = F.concat(F.lit("create table `"), F.col("db"), F.lit("`.`"), F.col("tbl"), F.lit("`\n(\n"), full, F.lit("\n)"))
    return g.select("db", "tbl", ddl.alias("ddl"))


#: Relative standard deviation of the distinct estimate that rules
#: candidates out, and how far below the row count an estimate must lie to
#: prove duplicates (ten deviations).
KEY_RSD = 0.01
KEY_SHARE = 0.9


def unique_keys(df: DataFrame, candidates: Sequence[Sequence[str]]) -> list[bool]:
    """Which candidate keys are unique in the data (nulls count as a
    value, as in a primary key's group by).

    One scan estimates every candidate's distinct values without a shuffle of
    rows; an estimate far below the row count proves duplicates.  The others
    are tested exactly, all in one scan, on 64-bit fingerprints: a
    fingerprint that two rows share is looked up once more on the columns
    themselves, since two different keys may share it."""
    prints = [F.xxhash64(F.lit(i), *[F.struct(F.col(c).isNull(), F.col(c)) for c in cols]) for i, cols in enumerate(candidates)]
    estimates = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.approx_count_distinct(h, KEY_RSD).alias(f"d{i}") for i, h in enumerate(prints)]).first()  # one row
    open_ = [i for i in range(len(candidates)) if estimates[f"d{i}"] >= KEY_SHARE * estimates["n"]]
    out = [False] * len(candidates)
    if not open_:
        return out
    tagged = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), prints[i].alias("h")) for i in open_])).alias("k"))
    shared = tagged.groupBy("k.i", "k.h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    clashing = {r.i for r in shared.select("i").distinct().collect()}  # candidate numbers
    for i in open_:
        if i not in clashing:
            out[i] = True
            continue
        cols = list(candidates[i])
        suspects = df.select(*cols, prints[i].alias("__h")).join(
            shared.filter(F.col("i") == i).select(F.col("h").alias("__h")), "__h", "left_semi")
        out[i] = not suspects.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).count()
    return out


def minimal_key(df: DataFrame, table: str, pk: Sequence[str], tenant: str = "tenant", id_col: str = "id") -> DataFrame:
    """Candidate key = (tenant, id) when the key starts with tenant and
    holds id, (id) when it holds id, else the key; the candidate is taken
    only if it is unique in the data (:func:`unique_keys`)."""
    pk = list(pk)
    if pk and pk[0] == tenant and id_col in pk:
        cand = [tenant, id_col]
    elif id_col in pk:
        cand = [id_col]
    else:
        cand = pk
    unique = unique_keys(df, [cand])[0]
    return df.sparkSession.createDataFrame(
        [(table, ",".join(cand), unique, ",".join(cand if unique else pk))],
        "tbl string, candidate string, candidate_unique boolean, chosen string")


# ---------------------------------------------------------------------------
# Schema files: one JSON array per database with records
# {table, type, columns[{name,type,len,nullable,default_value}], primary_keys,
#  record_count}.
COLUMN_STRUCT = "struct<name:string,type:string,len:bigint,nullable:string,default_value:string>"
RECORD_SCHEMA = (f"table string, type string, columns array<{COLUMN_STRUCT}>, "
                 "primary_keys string, record_count bigint")


def schema_records(schema_cols: DataFrame, record_counts: DataFrame | None = None,
                   kind: str = "kudu") -> DataFrame:
    """R7 records: one row per table with its ordered column list (bounded
    by the table's column count) and key list."""
    g = schema_cols.groupBy("db", "tbl").agg(
        F.array_sort(F.collect_list(F.struct("pos", "name", "type", "len", "nullable", "default_value"))).alias("cs"),
        F.array_sort(F.collect_list(F.when(F.col("is_key"), F.struct("pos", "name")))).alias("ks"))
    out = g.select(
        "db",
        F.concat(F.lit("`"), F.col("db"), F.lit("`.`"), F.col("tbl"), F.lit("`")).alias("table"),
        F.lit(kind).alias("type"),
        F.transform("cs", lambda c: F.struct(
            F.concat(F.lit("`"), c["name"], F.lit("`")).alias("name"), c["type"].alias("type"),
            c["len"].alias("len"), c["nullable"].alias("nullable"), c["default_value"].alias("default_value"))).alias("columns"),
        F.array_join(F.transform("ks", lambda k: F.concat(F.lit("`"), k["name"], F.lit("`"))), ",").alias("primary_keys"),
        "tbl",
    )
    if record_counts is not None:
        out = out.join(record_counts.select("db", "tbl", F.col("record_count").cast("bigint")), ["db", "tbl"], "left")
    else:
        out = out.withColumn("record_count", F.lit(None).cast("bigint"))
    return out.drop("tbl")


def write_schema_files(records: DataFrame, path: str) -> None:
    """One folder per database (``db=<name>``) of JSON records."""
    records.write.mode("overwrite").partitionBy("db").json(path)


def read_schema_files(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Schema records -> schema_cols rows (``explode`` of the column array).
    ``multiline=True`` reads JSON-array files (one array per database)."""
    r = spark.read.schema(RECORD_SCHEMA + ", db string").option("multiLine", multiline).json(path)
    bare = F.regexp_replace
    t = r.select(
        F.split(bare("table", "`", ""), "\\.").alias("__n"), "type", "primary_keys", "record_count",
        F.posexplode("columns").alias("__pos", "c"))
    keys = F.split(bare(F.coalesce("primary_keys", F.lit("")), "`", ""), ",")
    return t.select(
        F.element_at("__n", 1).alias("db"), F.element_at("__n", 2).alias("tbl"),
        (F.col("__pos") + 1).cast("int").alias("pos"), bare("c.name", "`", "").alias("name"),
        F.col("c.type").alias("type"), F.col("c.len").alias("len"), F.col("c.nullable").alias("nullable"),
        F.col("c.default_value").alias("default_value"),
        F.array_contains(keys, bare("c.name", "`", "")).alias("is_key"),
        F.col("type").alias("kind"), "record_count")
