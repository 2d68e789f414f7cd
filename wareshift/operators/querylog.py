"""Query-log operators (L1-L12): the statement log is a DataFrame; every
step is a narrow projection/filter or a key join, so the work spreads over
all partitions of the log and nothing passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareshift.functions import rules as R
from wareshift.operators.changes import dedupe_latest, reset_in_buckets, reset_slices, update_from, upsert


def _c(c):
    return F.col(c) if isinstance(c, str) else c


# L1
def slow_statements(log: DataFrame, max_duration: float = 30.0) -> DataFrame:
    """Slow, finished statements shorter than ``max_duration`` whose text
    was not cut (no ``...``), ordered by time then hash."""
    return log.filter(
        (F.col("type") == "slow")
        & (F.col("query_state") == "FINISHED")
        & (F.col("duration") < max_duration)
        & ~F.col("statement").contains("...")
    ).orderBy("created_at", "hash_id")


# L2
def strip_hints(text) -> Column:
    return F.regexp_replace(_c(text), R.HINT_PATTERN, "")


# L3
def tenant_of(user, db) -> Column:
    """Tenant from ``<t>_internal_write|read`` users, else from ``<t>_custom``
    databases; null when neither applies."""
    from_user = F.regexp_extract(_c(user), R.TENANT_USER_PATTERN, 1)
    matched = _c(user).rlike(R.TENANT_USER_PATTERN)
    from_db = F.replace(_c(db), F.lit(R.TENANT_DB_SUFFIX), F.lit(""))
    return F.when(matched, from_user).when(_c(db).endswith(R.TENANT_DB_SUFFIX), from_db)


def resolve_tenant(log: DataFrame, text: str = "statement", user: str = "user", db: str = "db") -> DataFrame:
    """Substitute ``{{tenant}}``; rows that need a tenant and have none are
    dropped, rows without the placeholder pass unchanged."""
    needs = F.col(text).contains(R.TENANT_PLACEHOLDER)
    tenant = tenant_of(user, db)
    return log.filter(~needs | tenant.isNotNull()).withColumn(
        text,
        F.when(needs, F.replace(F.col(text), F.lit(R.TENANT_PLACEHOLDER), tenant)).otherwise(F.col(text)),
    )


# L4
def rewrite_text(
    text,
    enabled=None,
    text_renames: Sequence[tuple[str, str]] = tuple(R.DEFAULT_TEXT_RENAMES),
) -> Column:
    """Ordered fold of the rewrite rules; the ``cast(x as string)`` rewrite
    applies only where ``enabled`` is true (all rows when it is None)."""
    out = _c(text)
    steps = list(R.TEXT_REWRITES_BEFORE_RENAMES) + list(text_renames) + list(R.TEXT_REWRITES_AFTER_RENAMES)
    for old, new in steps:
        out = F.replace(out, F.lit(old), F.lit(new))
    cast_fixed = F.regexp_replace(out, R.CAST_STRING_PATTERN, R.CAST_STRING_REPLACEMENT)
    if enabled is None:
        return cast_fixed
    return F.when(_c(enabled), cast_fixed).otherwise(out)


def rename_db(db, renames: Mapping[str, str] = R.DEFAULT_DB_RENAMES) -> Column:
    out = _c(db)
    expr = None
    for old, new in renames.items():
        expr = (F.when(out == old, F.lit(new)) if expr is None else expr.when(out == old, F.lit(new)))
    return out if expr is None else expr.otherwise(out)


def _any_of(needles: Sequence[str]) -> str:
    return "|".join(re.escape(n) for n in needles)


# L5
def is_noise(text) -> Column:
    """Whether a text holds any noise or tableau marker: one search for all."""
    return _c(text).rlike(_any_of(R.NOISE_MARKERS + R.TABLEAU_MARKERS))


def is_known_translate_error(err) -> Column:
    e = F.lower(_c(err))
    return e.contains(R.UNSUPPORTED_FUNCTION_ERROR) & e.rlike(_any_of(R.UNSUPPORTED_FUNCTIONS))


def drop_noise(log: DataFrame, text: str = "statement", db: str = "db", drop_dbs: Sequence[str] = ()) -> DataFrame:
    cond = ~F.coalesce(is_noise(text), F.lit(False))  # a row without a text or db is not noise
    if drop_dbs:
        cond = cond & ~F.coalesce(F.col(db).isin(list(drop_dbs)), F.lit(False))
    return log.filter(cond)


# L6
def _hits(text: Column, needles: Sequence[str]) -> Column:
    """The needles that occur in a text, found in one search.

    A lookahead is tried at every place, so needles that overlap are all
    found; of needles that begin at one place the longest is reported, which
    holds the others (see :func:`_implied`)."""
    longest = sorted(needles, key=lambda n: (-len(n), n))
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({_any_of(longest)}))"), F.lit(1)))


def _implied(needle: str, needles: Sequence[str]) -> list[str]:
    """The reports that show ``needle``: itself and the needles it begins."""
    return sorted(n for n in set(needles) if n.startswith(needle))


def classify_error(sql, err) -> Column:
    """First matching rule of ``ERROR_RULES`` on the lowered texts.

    Each text is searched once for all needles of the rules; the rules are
    then judged in order on the short lists of needles found."""
    texts = {"sql": F.lower(F.coalesce(_c(sql), F.lit(""))), "err": F.lower(F.coalesce(_c(err), F.lit("")))}
    needles = {f: [n for _, groups in R.ERROR_RULES for field, ns in groups if field == f for n in ns] for f in texts}

    def judge(found: Column) -> Column:
        expr = None
        for category, groups in R.ERROR_RULES:
            cond = F.lit(True)
            for field, any_of in groups:
                shown = sorted({x for n in any_of for x in _implied(n, needles[field])})
                cond = cond & F.arrays_overlap(found[field], F.array(*map(F.lit, shown)))
            expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
        return expr.otherwise(F.lit(R.DEFAULT_CATEGORY))

    # bound as a lambda's variable, so the searches are written (and run) once
    found = F.struct(*[_hits(texts[f], needles[f]).alias(f) for f in texts])
    return F.get(F.transform(F.array(found), judge), F.lit(0))


# L7
def drop_ignored(errors: DataFrame, category: str = "catalog") -> DataFrame:
    return errors.filter(~F.col(category).isin(R.IGNORED_CATEGORIES))


# L8
def outcome_rows(results: DataFrame) -> DataFrame:
    """Executed statements -> outcome columns.  ``results`` holds
    query_id, sql, err_msg, duration, executed_at and an optional
    ``timed_out`` flag; the timeout category is set before classification."""
    timed_out = F.col("timed_out") if "timed_out" in results.columns else F.lit(False)
    failed = F.coalesce(F.col("err_msg"), F.lit("")) != ""
    return results.select(
        "*",
        F.when(failed, F.lit(0)).otherwise(F.lit(1)).alias("execute_result"),
        F.when(~failed, F.lit(None).cast("string"))
        .when(timed_out, F.lit(R.TIMEOUT_CATEGORY))
        .otherwise(classify_error("sql", "err_msg"))
        .alias("catalog"),
    )


def record_outcome(statements: DataFrame, results: DataFrame, second_round: bool = False) -> DataFrame:
    """Write result/duration/time of executed statements into the log."""
    dur, res = ("tidb_duration2", "execute_result2") if second_round else ("tidb_duration", "execute_result")
    src = outcome_rows(results).select(
        "query_id",
        F.col("duration").alias(dur),
        F.col("execute_result").alias(res),
        F.col("executed_at").alias("execute_time"),
    )
    # of repeated outcomes of one statement the latest counts
    return update_from(statements, src, ["query_id"], [dur, res, "execute_time"], order_by=["execute_time"])


def record_errors(errors: DataFrame, results: DataFrame, sql_date: str) -> DataFrame:
    """Upsert the error rows of failed statements, skipping ignored categories."""
    failed = drop_ignored(outcome_rows(results).filter(F.col("execute_result") == 0))
    src = failed.select(
        "query_id", F.lit(sql_date).alias("sql_date"), "hash_id", "err_msg", "catalog"
    )
    return upsert(errors, src, ["query_id"], ["err_msg", "catalog"])


# L9
def claim_batch(statements: DataFrame, last_order_id: int, n: int, second_round: bool = False,
                sql_date: str | None = None, last_query_id: str | None = None) -> DataFrame:
    """Next ``n`` unexecuted statements after ``last_order_id`` with
    non-empty text and db (empty texts are filtered BEFORE the limit).

    Statements can share an ``order_id``: the next claim passes both ids of
    the last row, so the rest of a tie that the limit cut is claimed too."""
    text, res = ("tidb_sql2", "execute_result2") if second_round else ("tidb_sql", "execute_result")
    after = F.col("order_id") > F.lit(last_order_id)
    if last_query_id is not None:
        after = after | ((F.col("order_id") == F.lit(last_order_id)) & (F.col("query_id") > F.lit(last_query_id)))
    cond = (
        F.col(res).isNull()
        & after
        & (F.coalesce(F.col(text), F.lit("")) != "")
        & (F.coalesce(F.col("db"), F.lit("")) != "")
    )
    if sql_date is not None:
        cond = cond & (F.col("sql_date") == sql_date)
    return statements.filter(cond).orderBy("order_id", "query_id").limit(n)


# L10
def retry_worklist(errors: DataFrame, statements: DataFrame, categories: Sequence[str], sql_date: str) -> DataFrame:
    e = errors.filter(F.col("catalog").isin(list(categories)) & (F.col("sql_date") == sql_date))
    return e.select("query_id", "catalog").join(
        statements.select("query_id", "sql_type", "tiflash_only"), "query_id", "inner"
    )


def apply_retry(statements: DataFrame, errors: DataFrame, attempts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply retry attempts.  ``attempts``: query_id, translated (bool),
    new_sql, err_msg, duration, executed_at, timed_out; of repeated attempts
    at one statement the latest counts.

    * translation failed -> error category ``translate_error`` with the
      message, statement result reset to null and its text emptied;
    * executed ok -> text/duration/result 1/time stored, error row deleted;
    * executed with error -> result 0, text/time stored, error re-classified.

    One left join per table: the per-column conditions decide which columns
    an attempt overwrites."""
    a = dedupe_latest(attempts, ["query_id"], ["executed_at"]).select(
        F.col("query_id").alias("__q"), F.col("translated").alias("__tr"), F.col("new_sql").alias("__sql"),
        F.col("err_msg").alias("__err"), F.col("duration").alias("__dur"), F.col("executed_at").alias("__at"),
        F.coalesce(F.col("timed_out"), F.lit(False)).alias("__to"),
    ).withColumn("__ok", F.col("__tr") & (F.coalesce(F.col("__err"), F.lit("")) == ""))
    hit = F.col("__q").isNotNull()
    st = statements.join(a, F.col("query_id") == F.col("__q"), "left").withColumns({
        "tidb_sql": F.when(hit, F.when(F.col("__tr"), F.col("__sql")).otherwise(F.lit(""))).otherwise(F.col("tidb_sql")),
        "execute_result": F.when(hit, F.when(~F.col("__tr"), F.lit(None).cast("int"))
                                 .when(F.col("__ok"), F.lit(1)).otherwise(F.lit(0))).otherwise(F.col("execute_result")),
        "tidb_duration": F.when(hit & F.col("__ok"), F.col("__dur")).otherwise(F.col("tidb_duration")),
        "execute_time": F.when(hit & F.col("__tr"), F.col("__at")).otherwise(F.col("execute_time")),
    }).select(*statements.columns)
    category = (F.when(~F.col("__tr"), F.lit(R.TRANSLATE_ERROR_CATEGORY))
                .when(F.col("__to"), F.lit(R.TIMEOUT_CATEGORY))
                .otherwise(classify_error("__sql", "__err")))
    err = errors.join(a, F.col("query_id") == F.col("__q"), "left").filter(~F.coalesce(F.col("__ok"), F.lit(False)))
    err = err.withColumns({
        "err_msg": F.when(F.col("__q").isNotNull(), F.col("__err")).otherwise(F.col("err_msg")),
        "catalog": F.when(F.col("__q").isNotNull(), category).otherwise(F.col("catalog")),
    }).select(*errors.columns)
    return st, err


# L11
def progress(outcomes: DataFrame, ts: str = "execute_time", result: str = "execute_result",
             by: Sequence[str] = ()) -> DataFrame:
    """finished / failed counts and rate = finished per second of elapsed
    time, over all rows or per ``by``."""
    elapsed = F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))
    return outcomes.groupBy(*by).agg(
        F.count(F.col(result)).alias("finished"),
        F.sum(F.when(F.col(result) == 0, 1).otherwise(0)).alias("failed"),
        F.when(elapsed > 0, F.count(F.col(result)) / (elapsed / F.lit(1e6))).alias("rate"),
    )


# L12
def reset_run(statements: DataFrame, sql_date: str, buckets: int = 8) -> DataFrame:
    """Clear results of executed rows of one date; ``bucket`` is
    ``order_id % buckets``."""
    return reset_in_buckets(statements, _executed(sql_date), "execute_result", "order_id", buckets)


def reset_run_slices(spark: SparkSession, path: str, sql_date: str) -> list[int]:
    """The same on a stored statements table, slice by slice: only slices
    that hold such a row are written (see
    :func:`~wareshift.operators.changes.reset_slices`)."""
    return reset_slices(spark, path, _executed(sql_date), "execute_result")


def _executed(sql_date: str) -> Column:
    return (F.col("sql_date") == sql_date) & (F.col("execute_result") >= 0)
