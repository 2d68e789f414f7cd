"""Table-change queries (D1-D5, D7, D9, D15) and two source-side queries
(S7 insert text, S11 oversize split) on the driver tables.

The upsert source is derived from ``orders``: open orders re-priced with
version 2, urgent orders with a stale version-1 copy of the same key
(duplicate source keys), and high-priority orders re-keyed above the current
maximum (new rows).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareshift.operators import changes as D
from wareshift.plans.common import AS_OF, dec, ntz, tables
from wareshift.plans.registry import register
from wareshift.sources import inserts, logs

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "o_orderdate", "o_orderpriority"]

TARGET_SQL = """
target AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS price, o_orderdate, o_orderpriority FROM orders),
source AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, price + 100 AS price, o_orderdate, 'changed' AS o_orderpriority, 2 AS version
    FROM target WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, price - 100, o_orderdate, 'stale', 1 FROM target
    WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), o_custkey, 'N', price, o_orderdate, o_orderpriority, 1
    FROM target WHERE o_orderpriority = '2-HIGH'
),
src AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn FROM source) x WHERE rn = 1
)"""


def target_source(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    target = o.select("o_orderkey", "o_custkey", "o_orderstatus", dec("o_totalprice").alias("price"),
                      "o_orderdate", "o_orderpriority")
    top = o.agg((F.max("o_orderkey") + 1).alias("__shift"))  # one row
    opened = target.filter(F.col("o_orderstatus") == "O")
    changed = opened.select("o_orderkey", "o_custkey", "o_orderstatus", (F.col("price") + 100).alias("price"),
                            "o_orderdate", F.lit("changed").alias("o_orderpriority"), F.lit(2).alias("version"))
    stale = opened.filter(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("price") - 100).alias("price"), "o_orderdate",
        F.lit("stale").alias("o_orderpriority"), F.lit(1).alias("version"))
    new = target.filter(F.col("o_orderpriority") == "2-HIGH").crossJoin(F.broadcast(top)).select(
        (F.col("o_orderkey") + F.col("__shift")).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"),
        "price", "o_orderdate", "o_orderpriority", F.lit(1).alias("version"))
    return target, changed.unionByName(stale).unionByName(new)


# Insert new keys; on clash overwrite price only; newest version wins.
@register("upsert_orders", f"""
WITH {TARGET_SQL}
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CAST(CASE WHEN s.o_orderkey IS NOT NULL THEN s.price ELSE t.price END AS DECIMAL(38,2)) AS price,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM target t FULL JOIN src s ON s.o_orderkey = t.o_orderkey
""", "D1,J16")
def upsert_orders(spark, sf_dir):
    target, source = target_source(spark, sf_dir)
    return D.upsert(target, source, ["o_orderkey"],
                    ["price"], order_by=["version"]).select(*ORDER_COLS)


# New rows looked up in the old ones by natural key (customer, date):
# matched rows keep the old id, others get the next ids after the maximum.
@register("upsert_lookup", """
WITH old AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P'),
new AS (SELECT o_custkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
old1 AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS old_id FROM old GROUP BY o_custkey, o_orderdate),
j AS (SELECT n.*, o.old_id FROM new n LEFT JOIN old1 o ON o.o_custkey = n.o_custkey AND o.o_orderdate = n.o_orderdate)
SELECT CAST(old_id AS BIGINT) AS o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM j WHERE old_id IS NOT NULL
UNION ALL
SELECT CAST((SELECT coalesce(max(o_orderkey), 0) FROM old) +
       row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderpriority) AS BIGINT), o_custkey, o_orderdate, o_orderpriority
FROM j WHERE old_id IS NULL
""", "D2,D6")
def upsert_lookup(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    old = o.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey", "o_orderdate")
    new = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_custkey", "o_orderdate", "o_orderpriority")
    out = D.upsert_lookup(old, new, ["o_custkey", "o_orderdate"], "o_orderkey", order_by_extra=["o_orderpriority"])
    return out.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")


# D3: update by joined rows; a null in the source overwrites.
@register("update_from", """
WITH src AS (
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority || '*' END AS o_orderpriority
    FROM orders WHERE o_orderstatus = 'F'
)
SELECT o.o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE o.o_orderpriority END AS o_orderpriority,
       o.o_orderstatus
FROM orders o LEFT JOIN src s ON s.o_orderkey = o.o_orderkey
""", "D3")
def update_from(spark, sf_dir):
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    src = o.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(F.concat("o_orderpriority", F.lit("*"))).alias("o_orderpriority"))
    return D.update_from(o, src, ["o_orderkey"], ["o_orderpriority"])


# Segment renames applied by key-based CASE.
SEGMENT_RENAMES = {"AUTOMOBILE": "AUTO", "HOUSEHOLD": "HOME"}


# Per-id CASE, ELSE unchanged (mapping keyed by customer of a segment).
@register("update_case", """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTO' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""", "D4")
def update_case(spark, sf_dir):
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    keyed = c.withColumn("segment", F.col("c_mktsegment"))
    return D.update_by_case(keyed, "segment", "c_mktsegment", SEGMENT_RENAMES, spark).select("c_custkey", "c_mktsegment")


# Conditional update, soft delete and column copy.
@register("update_where", """
SELECT o_orderkey,
       o_orderstatus = 'P' AND o_totalprice < 50000 AS is_removed,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus END AS note
FROM orders
""", "D5,P6")
def update_where(spark, sf_dir):
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    o = o.withColumn("is_removed", F.lit(False)).withColumn("note", F.col("o_orderstatus"))
    o = D.update_where(o, (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000), {"is_removed": F.lit(True)})
    o = D.update_where(o, F.col("o_orderstatus") == "F", {"note": F.col("o_orderpriority")})
    return o.select("o_orderkey", "is_removed", "note")


# Delete by key (orders of customers in one segment).
@register("delete_keys", """
SELECT o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE')
""", "D7,J8")
def delete_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    doomed = t.customer.filter(F.col("c_mktsegment") == "FURNITURE").select(F.col("c_custkey").alias("o_custkey"))
    return D.delete_keys(t.orders.select("o_orderkey", "o_custkey"), doomed, ["o_custkey"]).select("o_orderkey")


# Flag rows whose ids are finished.
@register("mark_saved", """
SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') AS saved FROM orders
""", "D9,J7")
def mark_saved(spark, sf_dir):
    t = tables(spark, sf_dir)
    done = t.lineitem.filter(F.col("l_linestatus") == "F").select(F.col("l_orderkey").alias("o_orderkey"))
    return D.mark_saved(t.orders.select("o_orderkey"), done, "o_orderkey")


# D9 reversed: rows flagged as processed whose order holds no finished line
# are put back.
@register("unmark_unsaved", """
SELECT o_orderkey, o_orderstatus <> 'O' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') AS saved
FROM orders
""", "D9,J7")
def unmark_unsaved(spark, sf_dir):
    t = tables(spark, sf_dir)
    done = t.lineitem.filter(F.col("l_linestatus") == "F").select(F.col("l_orderkey").alias("o_orderkey"))
    flagged = t.orders.select("o_orderkey", (F.col("o_orderstatus") != "O").alias("saved"))
    held = D.mark_saved(flagged, done, "o_orderkey", "finished")
    return D.unmark_unsaved(held, ~F.col("finished")).select("o_orderkey", "saved")


# Version advanced on changed rows only.
@register("add_version", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS version FROM orders
""", "D15")
def add_version(spark, sf_dir):
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    return D.add_version(o, F.col("o_orderstatus") == "O").select("o_orderkey", "version")


# Insert statements, 1000 rows each.
@register("insert_values", """
WITH r AS (
    SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS seq,
           '(' || concat_ws(', ', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
                  '''' || replace(replace(o_orderstatus, '\\', '\\\\'), '''', '\\''') || '''',
                  CAST(o_totalprice AS VARCHAR), '''' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '''',
                  '''' || replace(replace(o_orderpriority, '\\', '\\\\'), '''', '\\''') || '''') || ')' AS row_text
    FROM orders
)
SELECT CAST(floor(seq / 1000) AS BIGINT) AS batch,
       'insert into orders (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority) values '
       || string_agg(row_text, ',' ORDER BY seq) AS stmt
FROM r GROUP BY 1
""", "S7,D12")
def insert_values(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    return inserts.to_insert_values(o, "orders", ["o_orderkey"], 1000).select("batch", "stmt")


OVERSIZE_CHARS = 20_000


# Oversize texts kept in a side store and re-attached on read.
@register("oversize_split", f"""
SELECT doc_id,
       CAST(CASE WHEN length(text) > {OVERSIZE_CHARS} THEN length('big_sql') ELSE length(text) END AS BIGINT) AS stored_chars,
       CAST(CASE WHEN length(text) > {OVERSIZE_CHARS} THEN length(text) END AS BIGINT) AS side_chars,
       true AS restored_ok
FROM documents
""", "S11")
def oversize_split(spark, sf_dir):
    """The texts cross one shuffle at most, that of the read side's join: what
    was stored and its fingerprint travel with the main rows."""
    d = tables(spark, sf_dir).documents.select("doc_id", "text", F.xxhash64("text").alias("print"))
    main, side = logs.split_oversize(d, "doc_id", "text", OVERSIZE_CHARS)
    main = main.withColumn("stored_chars", F.length("text").cast("bigint"))
    back = logs.reattach_oversize(main, side, "doc_id", "text")
    return back.select("doc_id", "stored_chars",
                       F.when(F.length("text") > OVERSIZE_CHARS, F.length("text")).cast("bigint").alias("side_chars"),
                       (F.xxhash64("text") == F.col("print")).alias("restored_ok"))


# Reset the status of done/failed rows, with the bucket column used to
# write the result in slices.
@register("reset_buckets", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CAST(o_orderkey % 8 AS BIGINT) AS bucket
FROM orders
""", "D8,D5")
def reset_buckets(spark, sf_dir):
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    out = D.reset_in_buckets(o, F.col("o_orderstatus").isin("F", "P"), "o_orderstatus", "o_orderkey", 8)
    return out.select("o_orderkey", "o_orderstatus", F.col("bucket").cast("bigint").alias("bucket"))


# ---------------------------------------------------------------------------
# Soft delete by a derived key set (the production UPDATE ... FROM ... JOIN
# whose SET named an alias that does not exist, meant as the target's own
# updated_at): parameter rows whose quantity node is a child of a selected
# parent (self join, parent_id > 0) or a selected root are marked removed,
# with reviser, version and updated_at set; all other rows are unchanged.
# Nodes: nations (roots, id = nation key) and customers (id = custkey + 100,
# parent = nation); parameters: orders.
SOFT_DELETE_WORKS = (1, 2, 3)
SOFT_DELETE_COMPONENT = 1
SOFT_DELETE_REVISER = 7
SOFT_DELETE_VERSION = 2

# Rule: an order points at a nation (keys that are multiples of ten: customer
# key modulo 25) or at its customer (id: key + 100).  It is marked if it is
# live and no feature, and the nation (its own, or its customer's) is in a
# selected region and has an odd key; a customer must be live too, and its
# nation's key above zero.
_SOFT_DELETE_SQL = f"""
WITH pointed AS (
    SELECT o.*, o_orderkey % 10 = 0 AS at_nation, c_nationkey, coalesce(c_custkey % 17 <> 0, false) AS live_customer
    FROM orders o LEFT JOIN customer ON c_custkey = o_custkey
), judged AS (
    SELECT p.*, coalesce(o_orderkey % 23 <> 0 AND o_orderkey % 9 <> 0 AND n_regionkey IN {SOFT_DELETE_WORKS}
           AND n_nationkey % 2 = {SOFT_DELETE_COMPONENT} AND (at_nation OR live_customer AND n_nationkey > 0), false) AS marked
    FROM pointed p LEFT JOIN nation ON n_nationkey = CASE WHEN at_nation THEN o_custkey % 25 ELSE c_nationkey END
)
SELECT o_orderkey AS id, CASE WHEN at_nation THEN o_custkey % 25 ELSE o_custkey + 100 END AS project_entry_work_quantity_id,
       CASE WHEN o_orderkey % 9 = 0 THEN 'feature' ELSE 'value' END AS param_type, marked OR o_orderkey % 23 = 0 AS is_removed,
       CASE WHEN marked THEN {SOFT_DELETE_REVISER} ELSE o_custkey END AS reviser,
       CASE WHEN marked THEN {SOFT_DELETE_VERSION} ELSE 1 END AS version,
       CASE WHEN marked THEN TIMESTAMP '{AS_OF.isoformat()} 00:00:00' ELSE o_orderdate END AS updated_at
FROM judged
"""


@register("soft_delete_params", _SOFT_DELETE_SQL, "D5,D9,J12,J7,U1,P6,P8,F12")
def soft_delete_params(spark, sf_dir):
    t = tables(spark, sf_dir)
    n = t.nation.select("n_nationkey", "n_regionkey")
    nations = n.select(F.col("n_nationkey").cast("bigint").alias("id"), F.lit(-1).cast("bigint").alias("parent_id"),
                       F.col("n_regionkey").cast("bigint").alias("work"),
                       (F.col("n_nationkey") % 2).cast("bigint").alias("component"), F.lit(False).alias("is_removed"))
    ck = F.col("c_custkey")
    customers = t.customer.select("c_custkey", "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        (ck + 100).alias("id"), F.col("c_nationkey").cast("bigint").alias("parent_id"),
        F.col("n_regionkey").cast("bigint").alias("work"), (F.col("n_nationkey") % 2).cast("bigint").alias("component"),
        (ck % 17 == 0).alias("is_removed"))
    live = nations.unionByName(customers).filter(~F.col("is_removed"))
    selected = live.filter(F.col("work").isin(*SOFT_DELETE_WORKS) & (F.col("component") == SOFT_DELETE_COMPONENT))
    children = live.filter(F.col("parent_id") > 0).join(
        selected.select(F.col("id").alias("pid")), F.col("parent_id") == F.col("pid"), "left_semi").select("id")
    roots = selected.filter(F.col("parent_id") == -1).select("id")
    quantity = children.unionByName(roots).select(F.col("id").alias("project_entry_work_quantity_id"))

    ok = F.col("o_orderkey")
    param = t.orders.select(
        ok.alias("id"),
        F.when(ok % 10 == 0, F.col("o_custkey") % 25).otherwise(F.col("o_custkey") + 100)
        .alias("project_entry_work_quantity_id"),
        F.when(ok % 9 == 0, "feature").otherwise("value").alias("param_type"),
        (ok % 23 == 0).alias("is_removed"), F.col("o_custkey").alias("reviser"),
        F.lit(1).cast("bigint").alias("version"), F.col("o_orderdate").alias("updated_at"))
    marked = D.mark_saved(param, quantity, "project_entry_work_quantity_id", "in_set")
    cond = F.col("in_set") & ~F.col("is_removed") & (F.col("param_type") != "feature")
    return D.update_where(marked, cond, {
        "is_removed": F.lit(True),
        "reviser": F.lit(SOFT_DELETE_REVISER).cast("bigint"),
        "version": F.lit(SOFT_DELETE_VERSION).cast("bigint"),
        "updated_at": ntz(AS_OF),
    }).drop("in_set")
