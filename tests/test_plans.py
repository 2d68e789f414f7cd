"""Plan-shape guards for the registered queries (sf0.001 plans have the
same shape as large-scale ones; AQE only re-plans at runtime)."""

import datetime as dt
import re

import pytest

import __spark_entry__ as E
from wareshift.plans import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)
# Queries whose only un-partitioned window is the per-partition offset of
# with_sequence (one row per partition).
SEQUENCE_QUERIES = {"sequence_ids", "sequence_runs", "insert_values", "upsert_lookup", "sort_mixed", "offset_only"}
HEADLINE_READS = {
    "pivot_flags": {"lineitem": {"l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"}},
    "latest_per_key": {"orders": {"o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"}},
    "plan_vs_actual": {"orders": {"o_custkey", "o_orderdate", "o_totalprice"}},
}


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


# What bounds the build side of a nested loop: a limit, a global aggregate,
# literal rows, or the set of distinct path lengths.
BOUNDED = re.compile(r"(Global|Local|Collect)Limit|TakeOrdered|keys=\[\]|LocalTableScan|keys=\[(__len|plen)")


def _built_sides(plan):
    """The sub-plans that nested loop joins build."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[\s:+\-*()\d]*", ln).group()) for ln in lines]
    for i, ln in enumerate(lines):
        m = re.search(r"BroadcastNestedLoopJoin (BuildLeft|BuildRight)", ln)
        if m:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            kids = [j for j in range(i + 1, end) if depth[j] == min(depth[i + 1 : end])]
            first, last = kids[0], kids[-1]
            yield "\n".join(lines[first:last] if m.group(1) == "BuildLeft" else lines[last:end])


def test_the_guard_sees_an_unbounded_side(spark):
    a, b = spark.range(10).alias("a"), spark.range(10).alias("b")
    joined = a.join(b.hint("broadcast"), a.id < b.id)
    sides = list(_built_sides(joined._jdf.queryExecution().executedPlan().toString()))
    assert len(sides) == 1 and not BOUNDED.search(sides[0])


@pytest.mark.parametrize("name", NAMES)
def test_no_unbounded_pairs(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    for side in _built_sides(plan):
        assert BOUNDED.search(side), side
    # windows are avoided (latest-per-key is a grouped aggregate); the only
    # window is with_sequence's running sum over one row per partition
    # no Python in any plan: every expression stays in the JVM
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas",
                 "PythonUDF"):
        assert node not in plan
    if name not in SEQUENCE_QUERIES:
        assert "Window" not in plan
    else:
        assert "__pid" in "".join(l for l in plan.splitlines() if "Window" in l)


@pytest.mark.parametrize("name", sorted(HEADLINE_READS))
def test_scans_are_pruned(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for table, cols in HEADLINE_READS[name].items():
        schemas = re.findall(rf"{table}\.parquet\].*?ReadSchema: struct<([^>]*)>", plan.replace("\n", " "))
        assert schemas, plan
        read = {c.split(":")[0] for c in schemas[0].split(",")}
        assert read == cols


def test_date_window_reaches_the_scan(spark):
    plan = _plan(spark, "plan_vs_actual").replace("\n", " ")
    pushed = re.findall(r"orders\.parquet\].*?PushedFilters: \[([^\]]*)\]", plan)
    assert pushed and "GreaterThanOrEqual(o_orderdate" in pushed[0] and "LessThan(o_orderdate" in pushed[0]


# The statements whose repeated line/order joins are folded into one pass:
# each table is scanned once (the bill list of bill_quantity aside, these
# read the big tables a single time).
SINGLE_PASS = {
    "purchase_need": {"lineitem": 1, "orders": 1},
    "category_dosage": {"lineitem": 1, "orders": 1},
    "day_plan_rates": {"orders": 1},
    "material_balance": {"lineitem": 1},
    "material_pivot": {"lineitem": 1, "orders": 1},
    # reads its checkpointed customer-day aggregate, never orders again
    "month_task_report": {"orders": 0},
    "month_progress": {"orders": 0},
    "month_report_status": {"orders": 0},
}


@pytest.mark.parametrize("name", sorted(SINGLE_PASS))
def test_folded_statements_scan_each_table_once(spark, name):
    plan = _plan(spark, name)
    for table, n in SINGLE_PASS[name].items():
        scans = [ln for ln in plan.splitlines() if "FileScan" in ln and f"{table}.parquet" in ln]
        assert len(scans) == n, (table, scans)


def test_offset_without_limit_has_no_single_task(spark):
    df = E.queries()["offset_only"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "Offset" not in plan
    # the one-partition exchange carries a row per range, not the rows
    lines = plan.splitlines()
    single = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert all("HashAggregate(keys=[__pid" in lines[i + 1] for i in single)


def test_ancestor_list_repeats_no_wide_row(spark):
    plan = _plan(spark, "ancestor_list")
    generate = [ln for ln in plan.splitlines() if "Generate" in ln or "BroadcastNestedLoopJoin" in ln]
    assert generate and all("amount" not in ln and "cnt" not in ln for ln in generate)


def test_allot_receive_keeps_every_item(spark, tmp):
    """Items of any material key come, not only of some; what was returned
    or has no material does not."""
    day = dt.datetime(1998, 3, 1)
    rows = [(1, 11, 4, 1, 5.0, 0.01, "N", "F", day), (2, 12, 4, 2, 6.0, 0.09, "A", "F", day), (3, 7, 3, 1, 7.0, 0.01, "N", "F", day),
            (3, 7, 3, 1, 7.0, 0.01, "N", "F", day), (4, 11, 4, 1, 8.0, 0.01, "R", "F", day), (5, None, 4, 1, 9.0, 0.01, "N", "F", day)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                          " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(
        f"{tmp}/lineitem.parquet")
    got = [(r.order_id, r.material_model, r.manufacturer) for r in E.queries()["allot_receive"](spark, tmp).collect()]
    assert got == [(1, "M11", "S4"), (3, "M7", None), (3, "M7", None), (2, "M12", None)]
