import datetime as dt
import json
import os
import uuid

from pyspark.sql import functions as F

from wareshift.streaming import landing as X


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, "." + name + ".tmp")
    with open(tmp, "w") as f:
        f.write("\n".join(json.dumps(x, ensure_ascii=False) for x in lines) + "\n")
    os.rename(tmp, os.path.join(folder, name))  # the rename marks the file ready


NAME = ""


def _task(i, **kw):
    t = {"queryId": f"q{i}", "tenant": "t", "db": "global_a", "duration": 1.5, "impalaSql": f"select {i}",
         "tidbSql": f"select {i}", "success": True, "error": None}
    t.update(kw)
    return t


def test_log_upsert_stream_is_incremental_and_idempotent(spark, tmp):
    global NAME
    NAME = f"logup-{uuid.uuid4().hex}"
    land = os.path.join(tmp, "landing")
    st, er, sv = (os.path.join(tmp, n) for n in ("statements", "errors", "saved"))
    _drop(land, "a.json", [
        _task(1, hash={"value": "h1", "valid": True}, sqlType="Query"),
        _task(2, impalaSql="select NDV(x) from t"),
        _task(3, success=False, error="boom", tidbSql="ignored"),
        _task(4, success=False, error="不支持转换的函数 instr"),
    ])
    q = X.stream_log_upsert(spark, land, st, er, sv, "0115", os.path.join(tmp, "big"), os.path.join(tmp, "bad"),
                            available_now=True, name=NAME)
    q.awaitTermination()
    rows = {r.query_id: r for r in X.read_state(spark, st, ["query_id"]).collect()}
    assert set(rows) == {"q1", "q3"}
    assert (rows["q1"].hash_id, rows["q1"].sql_type) == ("h1", "Query")
    assert (rows["q3"].hash_id, rows["q3"].sql_type, rows["q3"].tidb_sql) == ("", "unknown", "")
    assert [r.catalog for r in X.read_state(spark, er, ["query_id"]).collect()] == ["translate_error"]
    assert X.read_state(spark, sv, ["query_id"]).count() == 4

    # a second file: only it is processed; q1 is updated in place
    _drop(land, "b.json", [_task(1, tidbSql="select 'new'", hash={"value": "h1", "valid": True}), _task(5)])
    q = X.stream_log_upsert(spark, land, st, er, sv, "0115", os.path.join(tmp, "big"), os.path.join(tmp, "bad"),
                            available_now=True, name=NAME)
    q.awaitTermination()
    rows = {r.query_id: r for r in X.read_state(spark, st, ["query_id"]).collect()}
    assert set(rows) == {"q1", "q3", "q5"} and rows["q1"].tidb_sql == "select 'new'"
    # replaying an epoch rewrites its own folder only
    before = X.read_state(spark, st, ["query_id"]).count()
    b0 = spark.read.parquet(os.path.join(st, "batch=0")).drop("batch")
    replay = spark.createDataFrame(b0.collect(), b0.schema)  # a replay recomputes the same rows
    X.write_batch_state(replay, st, 0)
    assert X.read_state(spark, st, ["query_id"]).count() == before


def test_outcome_stream(spark, tmp):
    land = os.path.join(tmp, "results")
    rows = [("a", "h", "select 1", "", 1.0, dt.datetime(2024, 1, 1), False),
            ("b", "h", "select * from x full join y", "Column 'a' cannot be null", 2.0, dt.datetime(2024, 1, 1), False),
            ("c", "h", "insert into t", "Duplicate entry '1' in insert into t", 2.0, dt.datetime(2024, 1, 1), False),
            ("d", "h", "select 1", "Query execution was interrupted", 20.0, dt.datetime(2024, 1, 1), True)]
    spark.createDataFrame(rows, X.OUTCOME_SCHEMA).coalesce(1).write.parquet(land)
    out, err = os.path.join(tmp, "out"), os.path.join(tmp, "err")
    q = X.stream_outcomes(spark, land, out, err, "0115", available_now=True, name=f"outc-{uuid.uuid4().hex}")
    q.awaitTermination()
    res = {r.query_id: r.execute_result for r in X.read_state(spark, out, ["query_id"]).collect()}
    assert res == {"a": 1, "b": 0, "c": 0, "d": 0}
    cats = {r.query_id: r.catalog for r in X.read_state(spark, err, ["query_id"]).collect()}
    assert cats == {"b": "modify_full_join", "d": "timeout"}  # duplicate insert is ignored


def test_trigger_limits_and_retry_pass(spark, tmp):
    land = os.path.join(tmp, "files")
    for i in range(3):
        spark.createDataFrame([(i, "x")], "id int, s string").coalesce(1).write.parquet(os.path.join(land, f"p{i}"))
    seen = []
    flat = os.path.join(tmp, "flat")
    os.makedirs(flat)
    for i in range(3):
        sub = os.path.join(land, f"p{i}")
        for f in os.listdir(sub):
            if f.endswith(".parquet"):
                os.rename(os.path.join(sub, f), os.path.join(flat, f"{i}-{f}"))

    def fn(df, epoch):
        seen.append((epoch, df.count()))

    schema = "id int, s string"
    from pyspark.sql.types import _parse_datatype_string

    stream = X.stream_landing(spark, flat, _parse_datatype_string(schema), fmt="parquet", max_files=1)
    name = f"lim-{uuid.uuid4().hex}"
    q = X.start_loader(stream, fn, name, available_now=True)
    q.awaitTermination()
    assert [n for _, n in seen] == [1, 1, 1]
    seen.clear()
    X.run_retry_once(spark, flat, _parse_datatype_string(schema), fn, name)
    assert seen == []  # nothing new: the checkpoint remembers processed files
    assert F is not None


def test_restore_batches_by_count_size_and_wait(spark, tmp):
    from wareshift.streaming import landing as X

    mk = os.path.join(tmp, "markers")
    os.makedirs(mk)

    def marker(table, size):
        p = os.path.join(mk, f".{table}.tmp")
        with open(p, "w") as f:
            f.write(str(size))
        os.rename(p, os.path.join(mk, f"{table}.finish"))

    loads = []
    clock = {"t": 0.0}

    def load(df):
        loads.append(sorted(r.table for r in df.collect()))

    state = os.path.join(tmp, "state")
    name = f"restore-{uuid.uuid4().hex}"

    def run():
        X.stream_restore(spark, mk, state, load, lambda: clock["t"], name=name, available_now=True,
                         max_bytes=1000, max_tables=3, max_wait_seconds=300).awaitTermination()

    marker("d.a", 10)
    marker("d.b", 10)
    run()
    assert loads == []                      # 2 tables, 20 bytes, no wait yet
    marker("d.c", 10)
    run()
    assert loads == [["d.a", "d.b", "d.c"]]  # count reached: all pending
    marker("d.big", 5000)
    run()
    assert loads[-1] == ["d.big"]            # size reached
    marker("d.e", 1)
    clock["t"] = 10.0
    run()
    assert len(loads) == 2                  # waited 10 s since the last load
    clock["t"] = 400.0
    run()
    assert loads[-1] == ["d.e"]              # waited too long, with no later marker
    d = X.batch_decision(spark.createDataFrame([], "table string, size bigint"), 1e9).first()
    assert (d.tables, d.ready) == (0, False)


def test_state_compaction_keeps_latest_rows_and_prunes_old_epochs(spark, tmp):
    path = os.path.join(tmp, "state")
    want = {}
    for e in range(6):
        rows = [(f"k{i}", e * 100 + i) for i in range(e, e + 4)]
        X.write_batch_state(spark.createDataFrame(rows, "k string, v long"), path, e)
        if e == 3:
            full = {r.k: r.v for r in X.read_state(spark, path, ["k"]).collect()}
            assert X.compact_state(spark, path, ["k"], 3)
            assert not X.compact_state(spark, path, ["k"], 3)  # already in the index
            assert {r.k: r.v for r in X.read_state(spark, path, ["k"]).collect()} == full
        want.update(dict(rows))
    got = X.read_state(spark, path, ["k"])
    assert {r.k: r.v for r in got.collect()} == want
    # only the snapshot and the epochs after it are read: the epoch folders
    # are pruned at the scan
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln]
    filters = [ln.split("PartitionFilters:")[1].split("]")[0].strip() for ln in scans]
    assert any("> 3)" in f for f in filters)  # the epoch folders after the snapshot
    assert all(f == "[" or "> 3)" in f for f in filters)  # or the snapshot itself
    # the state as of an epoch before the snapshot still reads the folders
    assert {r.k: r.v for r in X.read_state(spark, path, ["k"], upto=1).collect()} == {
        "k0": 0, "k1": 101, "k2": 102, "k3": 103, "k4": 104}


def test_log_upsert_stream_with_compaction(spark, tmp):
    name = f"logup-compact-{uuid.uuid4().hex}"
    land = os.path.join(tmp, "landing")
    st, er, sv = (os.path.join(tmp, n) for n in ("statements", "errors", "saved"))
    _drop(land, "a.json", [_task(1), _task(2, success=False, error="boom")])
    X.stream_log_upsert(spark, land, st, er, sv, "0115", os.path.join(tmp, "big"), os.path.join(tmp, "bad"),
                        available_now=True, name=name, compact_every=1).awaitTermination()
    _drop(land, "b.json", [_task(1, tidbSql="select 'new'"), _task(3)])
    X.stream_log_upsert(spark, land, st, er, sv, "0115", os.path.join(tmp, "big"), os.path.join(tmp, "bad"),
                        available_now=True, name=name, compact_every=1).awaitTermination()
    assert X.latest_snapshot(spark, er) == 1 and X.latest_snapshot(spark, sv) == 1
    rows = {r.query_id: r.tidb_sql for r in X.read_state(spark, st, ["query_id"]).collect()}
    assert rows == {"q1": "select 'new'", "q2": "", "q3": "select 3"}
    assert X.read_state(spark, sv, ["query_id"]).count() == 3


def test_restore_batches_the_same_with_compaction(spark, tmp):
    # the scenario above with the state folded every epoch: same loads, and
    # the pending snapshot holds only tables that still wait
    mk = os.path.join(tmp, "markers")
    os.makedirs(mk)

    def marker(table, size):
        p = os.path.join(mk, f".{table}.tmp")
        with open(p, "w") as f:
            f.write(str(size))
        os.rename(p, os.path.join(mk, f"{table}.finish"))

    loads, clock = [], {"t": 0.0}
    state = os.path.join(tmp, "state")
    name = f"restore-compact-{uuid.uuid4().hex}"

    def run():
        X.stream_restore(spark, mk, state, lambda df: loads.append(sorted(r.table for r in df.collect())),
                         lambda: clock["t"], name=name, available_now=True, max_bytes=1000, max_tables=3,
                         max_wait_seconds=300, compact_every=1).awaitTermination()

    marker("d.a", 10)
    marker("d.b", 10)
    run()
    marker("d.c", 10)
    run()
    marker("d.big", 5000)
    run()
    marker("d.e", 1)
    clock["t"] = 10.0
    run()
    assert loads == [["d.a", "d.b", "d.c"], ["d.big"]]
    pending = os.path.join(state, "pending")
    snap = X.latest_snapshot(spark, pending)
    assert snap is not None and snap >= 3
    data = os.path.join(pending + ".snapshots", "data", f"upto={snap}")
    assert sorted(r.table for r in spark.read.parquet(data).collect()) == ["d.e"]
    clock["t"] = 400.0
    marker("d.f", 1)
    run()
    assert loads[-1] == ["d.e", "d.f"]
    clock["t"] = 401.0
    run()
    assert loads[-1] == ["d.e", "d.f"] and len(loads) == 3


def test_state_reads_from_the_snapshot_when_epoch_folders_are_gone(spark, tmp):
    # a snapshot whose epoch folders are not there (e.g. removed by a
    # retention job once the snapshot covered them) still reads back
    path = os.path.join(tmp, "state")
    rows = spark.createDataFrame([("k", 2), ("k0", 0), ("k1", 1), ("k2", 2)], "k string, v long")
    assert X.write_snapshot(spark, path, rows, 2)
    assert not os.path.exists(path)
    got = {r.k: r.v for r in X.read_state(spark, path, ["k"]).collect()}
    assert got == {"k": 2, "k0": 0, "k1": 1, "k2": 2}


def test_running_restore_loads_the_last_table_without_a_later_marker(spark, tmp):
    import time

    mk = os.path.join(tmp, "markers")
    os.makedirs(mk)
    with open(os.path.join(mk, "d.last.finish"), "w") as f:
        f.write("5")
    loads, clock = [], {"t": 0.0}
    q = X.stream_restore(spark, mk, os.path.join(tmp, "state"), lambda df: loads.append([r.table for r in df.collect()]),
                         lambda: clock["t"], name=f"restore-run-{uuid.uuid4().hex}", max_wait_seconds=300)
    try:
        until = time.time() + 60
        while q.lastProgress is None and time.time() < until:
            time.sleep(0.5)
        clock["t"] = 400.0
        while not loads and time.time() < until:
            time.sleep(0.5)
    finally:
        q.stop()
    assert loads == [["d.last"]]


def test_every_landed_row_is_in_exactly_one_output(spark, tmp):
    land = os.path.join(tmp, "landing")
    st, er, sv, big, bad = (os.path.join(tmp, n) for n in ("statements", "errors", "saved", "big", "bad"))
    _drop(land, "a.json", [
        _task(1), _task(2, success=False, error=None), _task(3, db=None), _task(4, tidbSql="x" * 50),
        _task(5, impalaSql="y" * 60), _task(6, db="noise_db"), {"tenant": "no id"}])
    with open(os.path.join(land, "broken.json"), "w") as f:
        f.write("{not json\n")
    X.stream_log_upsert(spark, land, st, er, sv, "0115", big, bad, available_now=True, name=f"all-{uuid.uuid4().hex}",
                        drop_dbs=["noise_db"], oversize_limit=40).awaitTermination()
    kept = {r.query_id: r for r in X.read_statements(spark, st).collect()}
    assert set(kept) == {"q1", "q2", "q3", "q4", "q5"}
    assert kept["q4"].tidb_sql == "big_sql" and kept["q5"].impala_sql == "big_sql"
    assert {(r.query_id, r.field, r.big_text) for r in spark.read.parquet(big).collect()} == {
        ("q4", "tidb_sql", "x" * 50), ("q5", "impala_sql", "y" * 60)}
    assert [r.query_id for r in X.read_state(spark, er, ["query_id"]).collect()] == ["q2"]
    assert sorted(json.loads(r.value)["tenant"] if "tenant" in r.value else r.value
                  for r in spark.read.parquet(bad).collect()) == ["no id", "{not json"]
    assert {r.query_id for r in spark.read.parquet(sv).collect()} == {f"q{i}" for i in range(1, 7)}


def test_replay_pipeline_connects(spark, tmp):
    from wareshift.operators import querylog as L

    land, res = os.path.join(tmp, "landing"), os.path.join(tmp, "results")
    st, er, sv, big, bad, out, err = (os.path.join(tmp, n) for n in ("st", "er", "sv", "big", "bad", "out", "err"))
    names = f"chain-{uuid.uuid4().hex}"

    def land_tasks():
        X.stream_log_upsert(spark, land, st, er, sv, "0115", big, bad, available_now=True, name=names).awaitTermination()

    _drop(land, "a.json", [_task(1), _task(2, tenant="first")])
    land_tasks()
    table = X.read_statements(spark, st, out)
    claimed = L.claim_batch(table, -1, 10)
    assert {r.query_id for r in claimed.collect()} == {"q1", "q2"}
    t0 = dt.datetime(2024, 1, 1)
    rows = [("q1", "h", "select 1", "", 1.0, t0, False), ("q2", "h", "select 2", "Lost connection", 9.0, t0, False)]

    def execute(rows, folder, second=False):
        path = os.path.join(res, folder)
        spark.createDataFrame(rows, X.OUTCOME_SCHEMA).coalesce(1).write.parquet(path)
        X.stream_outcomes(spark, path, out + ("2" if second else ""), err, "0115", available_now=True,
                          name=f"{names}-{folder}", second_round=second).awaitTermination()

    execute(rows, "one")
    # a repeated id changes the translated text only
    _drop(land, "b.json", [_task(2, tidbSql="select 'new'", tenant="second")])
    land_tasks()
    table = {r.query_id: r for r in X.read_statements(spark, st, out).collect()}
    assert (table["q1"].execute_result, table["q2"].execute_result) == (1, 0)
    assert table["q2"].tidb_sql == "select 'new'" and table["q2"].tenant == "first"
    assert L.claim_batch(X.read_statements(spark, st, out), -1, 10).count() == 0
    failed = X.read_state(spark, err, ["query_id"])
    flagged = X.read_statements(spark, st, out).withColumn("tiflash_only", F.lit(False))
    category = failed.first().catalog
    assert [r.query_id for r in L.retry_worklist(failed, flagged, [category], "0115").collect()] == ["q2"]
    # the same results again change nothing
    before = sorted(map(tuple, X.read_statements(spark, st, out).collect()))
    b0 = spark.read.parquet(os.path.join(out, "batch=0"))
    X.write_batch_state(spark.createDataFrame(b0.collect(), b0.schema), out, 0)
    assert sorted(map(tuple, X.read_statements(spark, st, out).collect())) == before


def test_ticks_without_markers_write_nothing(spark, tmp):
    import time

    marks, state = os.path.join(tmp, "marks"), os.path.join(tmp, "state")
    os.makedirs(marks)
    loads = []
    q = X.stream_restore(spark, marks, state, lambda df: loads.append(sorted(r.table for r in df.collect())),
                         clock=lambda: 0.0, name=f"ticks-{uuid.uuid4().hex}", max_tables=1)
    try:
        epochs = []
        for _ in range(60):
            time.sleep(1)
            if q.lastProgress and q.lastProgress["batchId"] not in epochs:
                epochs.append(q.lastProgress["batchId"])
            if len(epochs) == 2:
                break
        assert not os.path.exists(state)  # ticks alone
        with open(os.path.join(marks, ".a.b.tmp"), "w") as f:
            f.write("5")
        os.rename(os.path.join(marks, ".a.b.tmp"), os.path.join(marks, "a.b.finish"))
        for _ in range(60):
            time.sleep(1)
            if loads and q.lastProgress["batchId"] > epochs[-1] + 3:
                break
    finally:
        q.stop()
    assert loads == [["a.b"]]
    for name in ("pending", "loaded"):
        assert len([d for d in os.listdir(os.path.join(state, name)) if d.startswith("batch=")]) == 1


def test_retry_looks_again_and_again(spark, tmp):
    import time

    land = os.path.join(tmp, "retry")
    os.makedirs(land)
    df = spark.createDataFrame([(1,)], "k int")
    seen = []
    q = X.stream_retry(spark, land, df.schema, lambda b, _: seen.extend(r.k for r in b.collect()),
                       name=f"retry-{uuid.uuid4().hex}", every="1 second")
    try:
        for k in (1, 2):
            df.select(F.lit(k).alias("k")).coalesce(1).write.mode("append").parquet(land)
            for _ in range(40):
                time.sleep(0.5)
                if k in seen:
                    break
    finally:
        q.stop()
    assert seen == [1, 2] and X.RETRY_EVERY == "5 seconds"
