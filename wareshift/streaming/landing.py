"""Structured Streaming jobs replacing the polling loops.

* A landing folder is a file source: a file is picked up once, when it is
  complete (producers write to a temporary name and rename; the rename is
  the readiness marker).  Progress lives in the query checkpoint under the
  shared ``spark.checkpoint.dir``, so a restarted job resumes and a failed
  batch is retried -- the checkpoint only advances after the batch's sink
  write succeeded.
* Table state is kept as an append-only set of per-batch folders
  (``batch=<epoch>``) and read back as the latest row per key; a replayed
  epoch overwrites its own folder, so every batch is idempotent.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareshift.operators.changes import dedupe_latest
from wareshift.operators.querylog import drop_noise, is_known_translate_error, outcome_rows
from wareshift.session import checkpoint_root
from wareshift.sources.logs import OVERSIZE_LIMIT, parse_task_records, rejected_task_lines, split_oversize

# Load batch limits of the restore job.
BATCH_MAX_BYTES = 50 * 1024 ** 3
BATCH_MAX_FILES = 300
BATCH_WAIT = "5 minutes"
RETRY_EVERY = "5 seconds"
#: Epoch folders after which a state table is folded into a snapshot.
FOLD_AFTER = 50


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), "streams", name)


def stream_landing(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "text",
                   max_files: int | None = None, max_bytes: int | None = None,
                   options: dict | None = None) -> DataFrame:
    """Stream of a landing folder.  By default a trigger takes ALL
    pending files (as the original restore job did); ``max_files`` (e.g.
    ``BATCH_MAX_FILES``) or ``max_bytes`` (e.g. ``BATCH_MAX_BYTES``) cap a
    batch instead -- one or the other, Spark refuses both, bytes as a plain
    number.  Spark cannot start a batch early when a volume is reached; the
    processing-time trigger (``BATCH_WAIT``) is the clock."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_bytes is not None:
        r = r.option("maxBytesPerTrigger", str(int(max_bytes)))
    elif max_files is not None:
        r = r.option("maxFilesPerTrigger", int(max_files))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def _trigger(writer, available_now: bool, every: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)


def write_batch_state(batch: DataFrame, table_path: str, epoch_id: int) -> None:
    """Write one epoch's rows to its own folder (idempotent on replay)."""
    batch.withColumn("batch", F.lit(int(epoch_id)).cast("long")).write.mode("overwrite").parquet(
        os.path.join(table_path, f"batch={int(epoch_id)}"))


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet folder, or None if nothing was written to it yet; any other
    failure to read is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _snapshots(table_path: str) -> tuple[str, str]:
    root = table_path.rstrip("/") + ".snapshots"
    return os.path.join(root, "data"), os.path.join(root, "index")


def latest_snapshot(spark: SparkSession, table_path: str, upto: int | None = None) -> int | None:
    """Epoch of the newest complete snapshot (at most ``upto``), or None.
    The index holds one row per finished compaction."""
    _, index = _snapshots(table_path)
    idx = _read_if_there(spark, index)
    if idx is None:  # never compacted
        return None
    if upto is not None:
        idx = idx.filter(F.col("upto") <= upto)
    return idx.agg(F.max("upto").alias("e")).first()["e"]


def read_rows(spark: SparkSession, table_path: str, upto: int | None = None) -> DataFrame:
    """All rows of a state table up to epoch ``upto`` with their ``batch``:
    the newest snapshot (its rows carry the snapshot's epoch) plus the epoch
    folders after it -- the ``batch`` filter prunes the older folders, so the
    cost follows the snapshot size, not the stream's age."""
    snap = latest_snapshot(spark, table_path, upto)
    # the epoch folders may be gone once a snapshot covers them
    deltas = spark.read.parquet(table_path) if snap is None else _read_if_there(spark, table_path)
    if deltas is not None:
        deltas = deltas.withColumn("batch", F.col("batch").cast("long"))
        if upto is not None:
            deltas = deltas.filter(F.col("batch") <= upto)
    if snap is None:
        return deltas
    data, _ = _snapshots(table_path)
    base = spark.read.parquet(os.path.join(data, f"upto={int(snap)}")).withColumn(
        "batch", F.lit(int(snap)).cast("long"))
    return base if deltas is None else base.unionByName(deltas.filter(F.col("batch") > snap))


def read_state(spark: SparkSession, table_path: str, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """Current table (or the table as of epoch ``upto``): the latest
    epoch's row per key."""
    return dedupe_latest(read_rows(spark, table_path, upto), keys, order_by=["batch"]).drop("batch")


def write_snapshot(spark: SparkSession, table_path: str, rows: DataFrame, upto: int) -> bool:
    """Record ``rows`` as the state up to epoch ``upto``.  The snapshot goes
    to a fresh folder and is entered in the index only after it is
    completely written, so a job lost half-way leaves an unreferenced folder
    and readers keep using the previous state; rerunning it rewrites that
    folder.  A snapshot already in the index is not redone (returns False)."""
    data, index = _snapshots(table_path)
    if latest_snapshot(spark, table_path) is not None:
        if spark.read.parquet(index).filter(F.col("upto") == upto).limit(1).count():
            return False
    rows.drop("batch").write.mode("overwrite").parquet(os.path.join(data, f"upto={int(upto)}"))
    spark.createDataFrame([(int(upto),)], "upto long").write.mode("append").parquet(index)
    return True


def compact_state(spark: SparkSession, table_path: str, keys: Sequence[str], upto: int) -> bool:
    """Fold the epoch folders up to ``upto`` into one snapshot (latest row
    per key); see :func:`write_snapshot` for the crash safety."""
    return write_snapshot(spark, table_path, read_state(spark, table_path, keys, upto), upto)


def unfolded(spark: SparkSession, table_path: str) -> int:
    """Epoch folders that no snapshot covers (decisions made outside a
    micro-batch are not counted, and never folded)."""
    rows = _read_if_there(spark, table_path)
    if rows is None:
        return 0
    snap = latest_snapshot(spark, table_path)
    epochs = {int(e) for f in rows.inputFiles() for e in re.findall(r"/batch=(\d+)/", f)}
    return sum((-1 if snap is None else snap) < e < TICK_EPOCHS for e in epochs)


def _maybe_compact(spark: SparkSession, epoch_id: int, after: int, tables: Sequence[tuple[str, Sequence[str]]]):
    for path, keys in tables:
        if unfolded(spark, path) >= after:
            compact_state(spark, path, keys, epoch_id)


def start_loader(stream: DataFrame, fn: Callable[[DataFrame, int], None], name: str,
                 available_now: bool = False, every: str = BATCH_WAIT):
    """Run ``fn`` per micro-batch; the batch takes everything pending
    up to the per-trigger limit."""
    spark = stream.sparkSession
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint_for(spark, name))
    return _trigger(w, available_now, every).start()


def stream_log_upsert(spark: SparkSession, landing: str, statements_path: str, errors_path: str,
                      saved_path: str, sql_date: str, oversize_path: str, rejects_path: str,
                      available_now: bool = False, name: str = "log_upsert", drop_dbs: Sequence[str] = (),
                      compact_every: int = FOLD_AFTER, oversize_limit: int = OVERSIZE_LIMIT):
    """Task records (JSON lines) -> filter noise -> statements and error
    rows upserted by query id -> ids marked saved.

    Texts above ``oversize_limit`` characters (either text) go whole to
    ``oversize_path`` by query id and field, lines that are no task to
    ``rejects_path``; only parsed ids are marked saved.  ``order_id`` rises
    with the epoch.  The state tables are folded into a snapshot whenever
    ``compact_every`` epoch folders have come up."""
    raw = stream_landing(spark, landing, fmt="text")

    def batch(df: DataFrame, epoch_id: int) -> None:
        df.persist()  # read and parsed once for all sinks
        try:
            tasks = parse_task_records(df)
            known = F.coalesce(~F.col("success") & is_known_translate_error("err_msg"), F.lit(False))
            kept = drop_noise(tasks.withColumnRenamed("impala_sql", "statement"), drop_dbs=drop_dbs).filter(~known) \
                .withColumnRenamed("statement", "impala_sql")
            main, side = kept, None
            for text in ("impala_sql", "tidb_sql"):
                main, big = split_oversize(main, "query_id", text, oversize_limit)
                big = big.select("query_id", F.lit(text).alias("field"), "big_text")
                side = big if side is None else side.unionByName(big)
            # an order of the statements: the epoch, then the id's hash; two can share it, so claims go by (order_id, query_id)
            order_id = F.lit(int(epoch_id)) * F.lit(1 << 40) + F.pmod(F.xxhash64("query_id"), F.lit(1 << 40))
            st = main.select("query_id", order_id.alias("order_id"), "hash_id", "tenant", "db", "sql_type", "impala_sql",
                             "impala_duration", "tidb_sql", F.lit(sql_date).alias("sql_date"))
            write_batch_state(st, statements_path, epoch_id)
            errs = kept.filter(~F.coalesce("success", F.lit(False))).select(
                "query_id", F.lit(sql_date).alias("sql_date"), "hash_id", "err_msg",
                F.lit("translate_error").alias("catalog"))
            write_batch_state(errs, errors_path, epoch_id)
            write_batch_state(side, oversize_path, epoch_id)
            write_batch_state(rejected_task_lines(df), rejects_path, epoch_id)
            # every parsed id is finished (noise included), as in the source job
            write_batch_state(tasks.select("query_id"), saved_path, epoch_id)
        finally:
            df.unpersist()
        _maybe_compact(spark, epoch_id, compact_every, [(errors_path, ["query_id"]), (saved_path, ["query_id"])])

    return start_loader(raw, batch, name, available_now, "3 seconds")


def read_statements(spark: SparkSession, statements_path: str, outcomes_path: str | None = None) -> DataFrame:
    """The statements table that X3 and X4 keep, as ``claim_batch`` and
    ``retry_worklist`` read it.

    A repeated query id changes only the translated text (the first arrival
    keeps its other columns and its place); the outcome columns are those of
    the latest execution, per round."""
    rows = read_rows(spark, statements_path)
    fixed = [c for c in rows.columns if c not in ("query_id", "tidb_sql", "batch")]
    table = rows.groupBy("query_id").agg(
        F.min(F.struct("batch", *fixed)).alias("first"), F.max(F.struct("batch", "tidb_sql")).alias("last"))
    table = table.select("query_id", *[F.col(f"first.{c}").alias(c) for c in fixed], "last.tidb_sql")
    done = None
    if outcomes_path is not None:
        done = _read_if_there(spark, outcomes_path)
    none = {"execute_result": "int", "tidb_duration": "double", "execute_time": "timestamp_ntz",
            "execute_result2": "int", "tidb_duration2": "double"}
    if done is None:
        return table.withColumns({c: F.lit(None).cast(t) for c, t in none.items()})
    runs = read_rows(spark, outcomes_path)
    when = F.struct("execute_time", "batch", "execute_result", "tidb_duration")
    best = runs.groupBy("query_id").agg(F.max(F.when(~F.col("second_round"), when)).alias("one"),
                                        F.max(F.when(F.col("second_round"), when)).alias("two"))
    best = best.select(
        F.col("query_id").alias("__q"), F.col("one.execute_result").alias("execute_result"),
        F.col("one.tidb_duration").alias("tidb_duration"),
        F.greatest("one.execute_time", "two.execute_time").alias("execute_time"),
        F.col("two.execute_result").alias("execute_result2"), F.col("two.tidb_duration").alias("tidb_duration2"))
    return table.join(best, F.col("query_id") == F.col("__q"), "left").drop("__q")


OUTCOME_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()), T.StructField("hash_id", T.StringType()),
    T.StructField("sql", T.StringType()), T.StructField("err_msg", T.StringType()),
    T.StructField("duration", T.DoubleType()), T.StructField("executed_at", T.TimestampNTZType()),
    T.StructField("timed_out", T.BooleanType()),
])


def stream_outcomes(spark: SparkSession, landing: str, outcomes_path: str, errors_path: str,
                    sql_date: str, available_now: bool = False, name: str = "outcomes", fmt: str = "parquet",
                    compact_every: int = FOLD_AFTER, second_round: bool = False):
    """Executed-statement results -> outcome rows (result, duration,
    time, round), which :func:`read_statements` puts into the statements
    table, and classified error rows, ignored categories dropped."""
    from wareshift.operators.querylog import drop_ignored

    stream = stream_landing(spark, landing, OUTCOME_SCHEMA, fmt=fmt)

    def batch(df: DataFrame, epoch_id: int) -> None:
        rows = outcome_rows(df).persist()
        write_batch_state(rows.select("query_id", "execute_result", F.col("duration").alias("tidb_duration"),
                                      F.col("executed_at").alias("execute_time"),
                                      F.lit(second_round).alias("second_round")), outcomes_path, epoch_id)
        errs = drop_ignored(rows.filter(F.col("execute_result") == 0)).select(
            "query_id", F.lit(sql_date).alias("sql_date"), "hash_id", "err_msg", "catalog")
        write_batch_state(errs, errors_path, epoch_id)
        rows.unpersist()
        _maybe_compact(spark, epoch_id, compact_every, [(errors_path, ["query_id"])])

    return start_loader(stream, batch, name, available_now, "1 second")


def stream_retry(spark: SparkSession, landing: str, schema: T.StructType, fn: Callable[[DataFrame, int], None],
                 name: str = "retry", every: str = RETRY_EVERY):
    """Retry attempts as they come, looked for every ``RETRY_EVERY``; the
    attempts of one look are one batch.  Runs until it is stopped."""
    return start_loader(stream_landing(spark, landing, schema, fmt="parquet"), fn, name, every=every)


def run_retry_once(spark: SparkSession, landing: str, schema: T.StructType, fn: Callable[[DataFrame, int], None],
                   name: str = "retry"):
    """One ``availableNow`` pass over pending retry attempts
    (:func:`stream_retry` goes on looking)."""
    q = start_loader(stream_landing(spark, landing, schema, fmt="parquet"), fn, name, available_now=True)
    q.awaitTermination()
    return q


# ---------------------------------------------------------------------------
# X2 restore batching: ".finish" markers carry the byte size of a table's
# parts.  Newly ready tables are appended to a pending state; a load runs
# when the pending bytes exceed BATCH_MAX_BYTES, or at least BATCH_MAX_FILES
# tables wait, or the oldest wait exceeds the time limit -- and then takes
# ALL pending tables (the largest first).

MARKER_SUFFIX = ".finish"
# Epoch numbers of decisions made outside a micro-batch lie above all others.
TICK_EPOCHS = 10 ** 15


def marker_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of ready tables: (table, size) from ``<db>.<table>.finish``."""
    raw = spark.readStream.format("text").option("pathGlobFilter", f"*{MARKER_SUFFIX}").load(folder)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return raw.select(F.regexp_replace(name, r"\.finish$", "").alias("table"),
                      F.trim("value").try_cast("bigint").alias("size"))


def batch_decision(pending: DataFrame, waited_seconds: float, max_bytes: int = BATCH_MAX_BYTES,
                   max_tables: int = BATCH_MAX_FILES, max_wait_seconds: float = 300.0) -> DataFrame:
    """One row: pending tables and bytes, whether to load now, and why."""
    agg = pending.agg(F.count(F.lit(1)).alias("tables"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    waited = F.lit(float(waited_seconds))
    return agg.select(
        "tables", "bytes",
        F.when(F.col("bytes") > max_bytes, F.lit("size"))
        .when(F.col("tables") >= max_tables, F.lit("count"))
        .when((F.col("tables") > 0) & (waited > max_wait_seconds), F.lit("wait")).alias("reason"),
    ).withColumn("ready", F.col("reason").isNotNull())


def stream_restore(spark: SparkSession, markers: str, state_path: str, load: Callable[[DataFrame], None],
                   clock: Callable[[], float], name: str = "restore", available_now: bool = False,
                   max_bytes: int = BATCH_MAX_BYTES, max_tables: int = BATCH_MAX_FILES,
                   max_wait_seconds: float = 300.0, compact_every: int = FOLD_AFTER):
    """X1+X2: accumulate ready tables, load them in batches.  ``load`` gets
    the DataFrame of (table, size) to load; if it raises, the micro-batch
    fails and its markers are offered again after a restart (the checkpoint
    advances only on success).  The wait is measured from the last load, or
    from the first table seen when nothing was loaded yet; both times are
    kept in the state folders, so they survive restarts.  A trigger without
    markers writes nothing.  Whenever ``compact_every`` epoch folders have
    come up the state is folded: the loaded tables into one snapshot, and the
    pending rows of tables not loaded yet into another, so a trigger reads
    what is live, not the job's history."""
    pending_path = os.path.join(state_path, "pending")
    loaded_path = os.path.join(state_path, "loaded")

    def read_or_empty(path: str, schema: str) -> DataFrame:
        there = latest_snapshot(spark, path) is not None or _read_if_there(spark, path) is not None
        return read_rows(spark, path) if there else spark.createDataFrame([], schema)

    def batch(df: DataFrame, epoch_id: int) -> None:
        now = float(clock())
        fresh = df.filter(F.col("size").isNotNull())
        if not fresh.isEmpty():
            write_batch_state(fresh.withColumn("arrived", F.lit(now)), pending_path, epoch_id)
        decide(now, epoch_id)
        if max(unfolded(spark, pending_path), unfolded(spark, loaded_path)) >= compact_every:
            loaded_rows = read_or_empty(loaded_path, "table string, loaded_at double, batch long")
            waiting = read_rows(spark, pending_path).join(loaded_rows.select("table"), "table", "left_anti")
            write_snapshot(spark, loaded_path, loaded_rows.filter(F.col("batch") < TICK_EPOCHS), epoch_id)
            write_snapshot(spark, pending_path, waiting, epoch_id)

    def decide(now: float, epoch_id: int) -> None:
        pend = read_or_empty(pending_path, "table string, size bigint, arrived double, batch long")
        done = read_or_empty(loaded_path, "table string, loaded_at double, batch long")
        pending = pend.join(done.select("table"), "table", "left_anti").groupBy("table").agg(
            F.max("size").alias("size"))
        since = done.agg(F.max("loaded_at").alias("t")).first()["t"]
        if since is None:
            since = pend.agg(F.min("arrived").alias("t")).first()["t"]
        waited = 0.0 if since is None else now - since
        decision = batch_decision(pending, waited, max_bytes, max_tables, max_wait_seconds).first()
        if decision["ready"]:
            todo = pending.orderBy(F.col("size").desc())
            load(todo)
            write_batch_state(todo.select("table", F.lit(now).alias("loaded_at")), loaded_path, epoch_id)

    if not available_now:
        # a tick a second makes batches without new markers, so the wait
        # limit fires whether or not another marker follows
        tick = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(
            F.lit(None).cast("string").alias("table"), F.lit(None).cast("bigint").alias("size"))
        return start_loader(marker_stream(spark, markers).unionByName(tick), batch, name, False, "5 seconds")
    query = start_loader(marker_stream(spark, markers), batch, name, True, "5 seconds")
    query.awaitTermination()
    # the same decision once more, for tables left by runs without new markers
    now = float(clock())
    decide(now, TICK_EPOCHS + int(now * 1000))
    return query
