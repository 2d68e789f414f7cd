"""Log sources: JSON-lines task records (S5), statement scripts (S8) and
oversize text kept in a side store (S11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# API task record; hash and sqlType may be absent.
TASK_SCHEMA = T.StructType([
    T.StructField("queryId", T.StringType()),
    T.StructField("tenant", T.StringType()),
    T.StructField("db", T.StringType()),
    T.StructField("hash", T.StructType([T.StructField("value", T.StringType()), T.StructField("valid", T.BooleanType())])),
    T.StructField("sqlType", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("impalaSql", T.StringType()),
    T.StructField("tidbSql", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("error", T.StringType()),
])

OVERSIZE_LIMIT = 1_000_000  # characters
OVERSIZE_MARKER = "big_sql"


def parse_task_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """S5 on a frame of JSON lines: typed task columns with the defaults
    of the original (hash '' unless valid, sqlType 'unknown', translated
    text only when the translation succeeded).  Lines that are no task (no
    JSON object, or one without ``queryId``) are left to
    :func:`rejected_task_lines`."""
    r = lines.select(F.from_json(F.col(col), TASK_SCHEMA).alias("r")).select("r.*").filter(F.col("queryId").isNotNull())
    return r.select(
        F.col("queryId").alias("query_id"), "tenant", "db",
        F.when(F.col("hash.valid"), F.col("hash.value")).otherwise(F.lit("")).alias("hash_id"),
        F.coalesce("sqlType", F.lit("unknown")).alias("sql_type"),
        F.col("duration").alias("impala_duration"),
        F.col("impalaSql").alias("impala_sql"),
        F.when(F.col("success"), F.col("tidbSql")).otherwise(F.lit("")).alias("tidb_sql"),
        F.col("success"), F.col("error").alias("err_msg"),
    )


def rejected_task_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """The non-empty lines that :func:`parse_task_records` cannot use."""
    no_task = F.from_json(F.col(col), TASK_SCHEMA)["queryId"].isNull()
    return lines.filter(no_task & (F.trim(F.coalesce(F.col(col), F.lit(""))) != "")).select(col)


def read_log_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Newline-separated JSON objects -> (task rows, rejected lines)."""
    lines = spark.read.text(path)
    return parse_task_records(lines), rejected_task_lines(lines)


def read_statements(spark: SparkSession, path: str, replacements: dict[str, str] | None = None) -> DataFrame:
    """Script files -> one row per non-empty statement split on ';',
    with literal replacements applied."""
    # the text source cuts at ';' itself, so a large script is many records
    # that several tasks read; the order within a file is that of the records
    parts = spark.read.option("lineSep", ";").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("stmt"))
    out = parts.select("file", "pos", F.regexp_replace("stmt", r"^\s+|\s+$", "").alias("stmt")).filter(F.col("stmt") != "")
    for old, new in (replacements or {}).items():
        out = out.withColumn("stmt", F.replace("stmt", F.lit(old), F.lit(new)))
    return out


def is_oversize(*cols: Column, limit: int = OVERSIZE_LIMIT) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.coalesce(F.length(c), F.lit(0)) > limit)
    return cond


def split_oversize(df: DataFrame, key: str, text: str, limit: int = OVERSIZE_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(main, side).  Oversize texts go to the side store keyed by
    ``key``; the main row keeps the marker."""
    big = is_oversize(F.col(text), limit=limit)
    main = df.withColumn(text, F.when(big, F.lit(OVERSIZE_MARKER)).otherwise(F.col(text)))
    side = df.filter(big).select(key, F.col(text).alias("big_text"))
    return main, side


def reattach_oversize(main: DataFrame, side: DataFrame, key: str, text: str) -> DataFrame:
    """S11 read side: put the side text back where the marker is."""
    j = main.join(side, key, "left")
    return j.withColumn(text, F.when((F.col(text) == OVERSIZE_MARKER) & F.col("big_text").isNotNull(),
                                     F.col("big_text")).otherwise(F.col(text))).drop("big_text")
