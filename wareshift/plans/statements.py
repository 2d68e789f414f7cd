"""Production statements of the reporting workload modelled whole on the
driver tables (each with its DuckDB oracle).  Where a statement repeats a
join of the two largest tables, the Spark form folds the repeats into one
pass; each docstring says how."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareshift.functions import scalars as S
from wareshift.operators import joins as J
from wareshift.plans.common import AS_OF, add_months, dec, ntz, tables
from wareshift.plans.registry import register


# ---------------------------------------------------------------------------
# Bill quantity report (the production statement behind J5 and the
# IN-after-DISTINCT note): every bill node p is joined to the leaf nodes c
# of the same org and bill whose path starts with p's path (textual prefix,
# so customer 12 also takes customer 123 of the same nation), the leaves to
# their quantity rows (factor null -> 1); non-leaf nodes report null, leaves
# the rounded sums.  Nodes: region | nation | customer; org and bill = the
# region; quantities = finished orders; soft-deleted rows made by CASE.
_BILL_FACTOR_SQL = ("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CASE o_orderkey % 4 WHEN 0 THEN '1.00' "
                    "WHEN 1 THEN '1.25' WHEN 2 THEN '1.50' ELSE '1.75' END AS DECIMAL(5,2)) END")


# Rule: a node is a region, a nation or a live customer; its id is the keys
# from the region down.  A node is reported if a live customer of the region
# has an id that starts with it, and the region has live finished orders.
# Customers report the amounts (times factor) of the customers so found, and
# the same rounded per order and priced; other nodes report null.
@register("bill_quantity", f"""
WITH live_order AS (
    SELECT o_custkey, CAST(o_totalprice AS DECIMAL(15,2)) * coalesce({_BILL_FACTOR_SQL}, 1) AS amount
    FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 31 <> 0
), region_with_orders AS (
    SELECT DISTINCT n_regionkey FROM live_order JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
), buyer AS (
    SELECT n_regionkey, n_regionkey || '|' || n_nationkey AS above, n_regionkey || '|' || n_nationkey || '|' || c_custkey AS id,
           c_name, c_mktsegment, c_custkey, CAST(c_acctbal AS DECIMAL(15,2)) AS price,
           sum(amount) AS amount, CAST(sum(round(amount, 3)) AS DECIMAL(20,3)) AS rounded
    FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN live_order ON o_custkey = c_custkey
    WHERE c_custkey % 29 <> 0
    GROUP BY ALL
), node AS (
    SELECT n_regionkey, id, above AS parent_id, c_name AS name, 'C' || c_custkey AS code, c_mktsegment AS unit, price,
           true AS sells FROM buyer
    UNION ALL SELECT n_regionkey, n_regionkey || '|' || n_nationkey, CAST(n_regionkey AS VARCHAR), n_name, 'N' || n_nationkey,
           '', NULL, false FROM nation
    UNION ALL SELECT r_regionkey, CAST(r_regionkey AS VARCHAR), NULL, r_name, 'R' || r_regionkey, '', NULL, false FROM region
), found AS (
    SELECT node.id, parent_id, name, code, unit, CAST(node.price AS DECIMAL(38,2)) AS price,
           CASE WHEN sells THEN round(sum(b.amount), 3) END AS quantity,
           CASE WHEN sells THEN round(sum(b.rounded * b.price), 3) END AS money
    FROM node JOIN buyer b ON b.n_regionkey = node.n_regionkey AND starts_with(b.id, node.id)
    WHERE node.n_regionkey IN (FROM region_with_orders)
    GROUP BY node.id, parent_id, name, code, unit, node.price, sells
)
SELECT id, parent_id, name, code, unit, price, quantity AS review_quantity, money AS review_price,
       quantity AS reside_quantity, money AS reside_price
FROM found
""", "J5,J7,J2,P6,A2,F1,F3,F5,F11,P12,T1")
def bill_quantity(spark, sf_dir):
    t = tables(spark, sf_dir)
    n = t.nation.select("n_nationkey", "n_regionkey", "n_name")
    cust = t.customer.select("c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_acctbal").join(
        n, F.col("c_nationkey") == F.col("n_nationkey"))
    none = F.lit(None).cast("string")
    no_price = F.lit(None).cast("decimal(15,2)")

    def node(frame, id_, parent, name, code, unit, price, org, leaf, level, order_no, removed):
        return frame.select(id_.alias("id"), parent.alias("parent_id"), name.alias("name"), code.alias("code"),
                            unit.alias("unit"), price.alias("price"), org.alias("org_id"), org.alias("bill_id"),
                            F.lit(leaf).alias("is_leaf"), F.lit(level).alias("level"),
                            order_no.cast("bigint").alias("order_no"), removed.alias("is_removed"))

    rk = F.col("r_regionkey")
    regions = node(t.region, rk.cast("string"), none, F.col("r_name"), F.concat(F.lit("R"), rk.cast("string")),
                   F.lit(""), no_price, rk, False, 1, rk, F.lit(False))
    nk, nrk = F.col("n_nationkey"), F.col("n_regionkey")
    nations = node(n, F.concat_ws("|", nrk, nk), nrk.cast("string"), F.col("n_name"),
                   F.concat(F.lit("N"), nk.cast("string")), F.lit(""), no_price, nrk, False, 2, nk, F.lit(False))
    ck = F.col("c_custkey")
    customers = node(cust, F.concat_ws("|", nrk, nk, ck), F.concat_ws("|", nrk, nk), F.col("c_name"),
                     F.concat(F.lit("C"), ck.cast("string")), F.col("c_mktsegment"), dec("c_acctbal"), nrk,
                     True, 3, ck, (ck % 29) == 0)
    detail = regions.unionByName(nations).unionByName(customers).filter(~F.col("is_removed"))

    # Quantity rows of the unit of work, summed per customer before any join:
    # the shuffle carries one row per customer.  Per leaf the price is one
    # value, so sum(round(q*f, 3) * price) = price * sum(round(q*f, 3)), exactly.
    k = F.col("o_orderkey")
    factor = (F.when(k % 7 == 0, F.lit(None))
              .otherwise(F.when(k % 4 == 0, "1.00").when(k % 4 == 1, "1.25").when(k % 4 == 2, "1.50")
                         .otherwise("1.75").cast("decimal(5,2)")))
    qf = dec("o_totalprice") * F.coalesce(factor, F.lit(1))
    pq = (t.orders.filter((F.col("o_orderstatus") == "F") & ((k % 31) != 0))
          .groupBy("o_custkey").agg(F.sum(qf).alias("sq"), F.sum(F.round(qf, 3)).alias("sr")))
    leaves = (customers.filter(~F.col("is_removed"))
              .join(pq, F.col("order_no") == F.col("o_custkey"), "left")  # order_no is the customer key
              .select("org_id", "bill_id", F.col("id").alias("leaf_path"), "sq",
                      (F.col("sr") * F.col("price")).alias("srp"), F.lit(1).alias("leaves")))
    # bills with quantity rows: IN (SELECT DISTINCT ...) as a semi join; this
    # pass reads only the key columns of orders and shuffles distinct keys
    bills = (pq.select("o_custkey")
             .join(cust.select("c_custkey", "n_regionkey"), F.col("o_custkey") == F.col("c_custkey"))
             .select(F.col("n_regionkey").alias("bill_id")).distinct())
    parents = detail.join(bills, "bill_id", "left_semi")
    rolled = J.ancestor_rollup(leaves, "leaf_path", {"sq": F.sum("sq"), "srp": F.sum("srp"), "leaves": F.sum("leaves")},
                               parents, "id", keys=["org_id", "bill_id"], mode="string", leaf_unique=True)
    leaf_only = lambda c: F.when(F.col("is_leaf"), F.round(F.col(c), 3))
    return (rolled.filter(F.col("leaves").isNotNull())
            .orderBy("level", "order_no")
            .select("id", "parent_id", "name", "code", "unit", "price",
                    leaf_only("sq").alias("review_quantity"), leaf_only("srp").alias("review_price"),
                    leaf_only("sq").alias("reside_quantity"), leaf_only("srp").alias("reside_price")))


# ---------------------------------------------------------------------------
# Bill tree of a resume part (the production statement behind J6): the
# detail nodes that have quantity rows of the part, every node of the same
# org and bill whose full_id occurs anywhere in theirs (textual locate, so
# nation 1 also occurs in '11|...'), de-duplicated, under the bill root
# rows.  Bills = regions; details = nations (full_id 'n') and customers
# (id custkey + 100, full_id 'n|id'); part quantities = urgent orders.
# Rule: nodes are nations (path: nation key) and live customers (id: key +
# 100; path: nation | id).  Customers with a live urgent order are picked.
# Reported: each region with a picked customer, and each node whose path
# occurs anywhere in the path of a picked customer of its region.
@register("bill_tree", """
WITH node AS (
    SELECT n_regionkey AS region, n_nationkey AS id, NULL AS nation, CAST(n_nationkey AS VARCHAR) AS path,
           'N' || n_nationkey AS code, n_name AS name, NULL AS unit
    FROM nation
    UNION ALL
    SELECT n_regionkey, c_custkey + 100, n_nationkey, n_nationkey || '|' || (c_custkey + 100),
           CASE WHEN c_custkey % 13 <> 0 THEN 'C' || c_custkey ELSE '' END, c_name, c_mktsegment
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 23 <> 0
), picked AS (
    SELECT region, path FROM node
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey + 100 = id AND o_orderkey % 31 <> 0 AND o_orderpriority = '1-URGENT')
)
SELECT CAST(r_regionkey AS BIGINT) AS id, CAST(-1 AS BIGINT) AS parent_id, CAST(r_regionkey AS VARCHAR) AS full_id,
       'R' || r_regionkey AS code, r_name AS name, NULL AS unit
FROM region WHERE EXISTS (SELECT 1 FROM picked WHERE region = r_regionkey)
UNION ALL
SELECT id, coalesce(nation, region), region || '|' || path, code, name, unit
FROM node WHERE EXISTS (SELECT 1 FROM picked WHERE picked.region = node.region AND contains(picked.path, node.path))
""", "J6,J7,J1,U1,A5,F1,F3,F8,P6,P12,T1")
def bill_tree(spark, sf_dir):
    t = tables(spark, sf_dir)
    n = t.nation.select("n_nationkey", "n_regionkey", "n_name")
    nk, rk = F.col("n_nationkey"), F.col("n_regionkey").cast("bigint")
    nations = n.select(nk.cast("bigint").alias("id"), F.lit(-1).cast("bigint").alias("parent_id"),
                       nk.cast("string").alias("full_id"), F.concat(F.lit("N"), nk.cast("string")).alias("code"),
                       F.col("n_name").alias("name"), F.lit(None).cast("string").alias("unit"), rk.alias("org_id"),
                       rk.alias("bill_id"), nk.cast("bigint").alias("order_no"), F.lit(False).alias("is_removed"))
    ck = F.col("c_custkey")
    did = ck + 100
    customers = t.customer.select("c_custkey", "c_nationkey", "c_name", "c_mktsegment").join(
        n, F.col("c_nationkey") == nk).select(
        did.alias("id"), nk.cast("bigint").alias("parent_id"), F.concat_ws("|", nk, did).alias("full_id"),
        F.when(ck % 13 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), ck.cast("string"))).alias("code"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("unit"), rk.alias("org_id"), rk.alias("bill_id"),
        ck.alias("order_no"), (ck % 23 == 0).alias("is_removed"))
    detail = nations.unionByName(customers).filter(~F.col("is_removed")).drop("is_removed")

    k = F.col("o_orderkey")
    q = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & ((k % 31) != 0)).select(
        (F.col("o_custkey") + 100).alias("detail_id"))
    bill_detail = (q.join(detail.select("id", "bill_id", "org_id"), F.col("detail_id") == F.col("id"))
                   .select("bill_id", "detail_id", "org_id").distinct())

    roots = t.region.join(bill_detail.select("bill_id"), F.col("r_regionkey") == F.col("bill_id"), "left_semi").select(
        F.col("r_regionkey").cast("bigint").alias("id"), F.lit(-1).cast("bigint").alias("parent_id"),
        F.col("r_regionkey").cast("string").alias("full_id"),
        S.ifnull(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")), "").alias("code"),
        S.ifnull("r_name", "").alias("name"), F.lit(None).cast("string").alias("unit"),
        F.lit(1).alias("level"), F.col("r_regionkey").cast("bigint").alias("order_no"))

    # the two IN lists are separate conditions (org in one, id in the other)
    bc = (detail.join(bill_detail.select("org_id").distinct(), "org_id", "left_semi")
          .join(bill_detail.select(F.col("detail_id").alias("id")), "id", "left_semi")
          .select("org_id", "bill_id", F.col("full_id").alias("c_full_id")))
    hits = J.contained_in_any(detail, bc, "full_id", "c_full_id", keys=["org_id", "bill_id"])
    nodes = hits.select(
        "id", F.when(F.col("parent_id") == -1, F.col("bill_id")).otherwise(F.col("parent_id")).alias("parent_id"),
        F.concat_ws("|", F.col("bill_id").cast("string"), F.col("full_id")).alias("full_id"),
        S.ifnull("code", "").alias("code"), S.ifnull("name", "").alias("name"), "unit",
        F.lit(2).alias("level"), "order_no").distinct()
    return (roots.unionByName(nodes).orderBy("level", "order_no")
            .select("id", "parent_id", "full_id", "code", "name", "unit"))


# ---------------------------------------------------------------------------
# Purchase need report (the production statement behind A8): planned
# material quantities per child org minus the purchased ones, kept where
# the remainder is positive (HAVING written without GROUP BY, meant as a
# filter), with the stock of the same org and material attached.  Plan
# heads = submitted orders, purchase heads = urgent/high orders, stock =
# open lines; materials = parts; soft-deleted and null quantities by CASE.
# Rule: of the customers in credit, per customer and part, what submitted
# orders plan less what urgent and high orders buy, where something is left;
# with the open lines' quantity as stock.
@register("purchase_need", """
WITH moved AS (
    SELECT o_custkey AS org_id, l_partkey AS material_id,
           CASE WHEN l_orderkey % 19 <> 0 THEN CAST(l_quantity AS DECIMAL(15,2)) END AS q,
           o_orderkey % 37 <> 0 AND o_orderstatus IN ('F', 'P') AS planned,
           o_orderkey % 37 <> 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AS bought, l_linestatus = 'O' AS open
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    WHERE l_linenumber <> 7 AND c_acctbal > 0
), balance AS (
    SELECT org_id, material_id, coalesce(sum(q) FILTER (planned), 0) AS planned, coalesce(sum(q) FILTER (bought), 0) AS bought,
           coalesce(sum(q) FILTER (open), 0) AS stock, count(*) FILTER (planned) AS plans
    FROM moved GROUP BY ALL
)
SELECT stock AS inventory_quantity, CAST(planned AS DECIMAL(38,4)) AS plan_quantity,
       CAST(bought AS DECIMAL(38,4)) AS purchase_quantity, CAST(planned - bought AS DECIMAL(38,4)) AS need_quantity,
       org_id, material_id, 'M' || material_id % 50 AS material_model, 'P' || material_id AS material_code,
       'material ' || material_id AS material_name, ['t', 'm3', 'kg'][1 + material_id % 3] AS material_unit
FROM balance WHERE plans > 0 AND planned > bought
""", "A8,A1,A10,J2,J7,F1,F5,P6,P8,P12,T1")
def purchase_need(spark, sf_dir):
    """One join of lines to orders and one aggregate for all three measures
    (plan, purchase, stock): the statement's three scans of the two largest
    tables become one, and the shuffle carries partial sums per (org,
    material).  Stock rows of orgs outside the IN list never reach the
    result, so that semi join filters all three measures."""
    t = tables(spark, sf_dir)
    pk = F.col("l_partkey")
    lk = F.col("l_orderkey")
    qty = F.when(lk % 19 == 0, F.lit(None)).otherwise(dec("l_quantity"))
    items = t.lineitem.filter(F.col("l_linenumber") != 7).select(
        F.col("l_orderkey").alias("order_id"), pk.alias("material_id"), qty.alias("quantity"), "l_linestatus")
    orgs = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("child_org_id"))
    ok = F.col("o_orderkey")
    heads = t.orders.join(orgs, F.col("o_custkey") == F.col("child_org_id"), "left_semi").select(
        ok.alias("id"), F.col("o_custkey").alias("org_id"),
        ((ok % 37 != 0) & F.col("o_orderstatus").isin("F", "P")).alias("is_plan"),
        ((ok % 37 != 0) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("is_purchase"))
    j = items.join(heads, F.col("order_id") == F.col("id"))
    q = F.col("quantity")
    g = j.groupBy("org_id", "material_id").agg(
        F.count(F.when(F.col("is_plan"), 1)).alias("plan_rows"),
        F.sum(F.when(F.col("is_plan"), q)).alias("plan"),
        F.sum(F.when(F.col("is_purchase"), q)).alias("purchase"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.coalesce(q, F.lit(0)))).alias("stock"))
    plan = S.ifnull("plan", 0)
    purchase = S.ifnull("purchase", 0)
    m = F.col("material_id")
    out = g.filter((F.col("plan_rows") > 0) & ((plan - purchase) > 0)).select(
        S.ifnull("stock", 0).alias("inventory_quantity"),
        plan.cast("decimal(28,4)").alias("plan_quantity"),
        purchase.cast("decimal(28,4)").alias("purchase_quantity"),
        (plan - purchase).cast("decimal(28,4)").alias("need_quantity"),
        "org_id", "material_id",
        F.concat(F.lit("M"), (m % 50).cast("string")).alias("material_model"),
        F.concat(F.lit("P"), m.cast("string")).alias("material_code"),
        F.concat(F.lit("material "), m.cast("string")).alias("material_name"),
        F.when(m % 3 == 0, "t").when(m % 3 == 1, "m3").otherwise("kg").alias("material_unit"))
    return out.orderBy(F.col("need_quantity").desc(), "org_id", "material_id")


# ---------------------------------------------------------------------------
# Allotted items with their receiving records.  Rule: an item is a line that
# was not returned, its material's name and model matching the empty search
# patterns (any text does, a null does not); its record, if it has one, is
# the line of the same bar code when finished, of a supplier key that is no
# multiple of three and a tax below five percent.  (The SQL keeps the
# statement's IN over the left side; a left join can match no other right
# rows, so the query leaves it out.)
@register("allot_receive", """
WITH item AS (
    SELECT *, l_orderkey || '-' || l_linenumber AS bar_code FROM lineitem
    WHERE l_returnflag <> 'R' AND ('material ' || l_partkey) LIKE '%%' AND ('M' || (l_partkey % 50)) LIKE '%%'
), record AS (
    SELECT * FROM (SELECT *, l_orderkey || '-' || l_linenumber AS bar_code FROM lineitem)
    WHERE l_linestatus = 'F' AND l_suppkey % 3 <> 0 AND l_tax < 0.05 AND bar_code IN (SELECT bar_code FROM item)
)
SELECT item.l_orderkey * 8 + item.l_linenumber AS id, item.l_orderkey AS order_id, item.l_partkey AS material_id,
       concat('material ', item.l_partkey) AS material_name, concat('M', item.l_partkey % 50) AS material_model,
       CAST(CAST(item.l_quantity AS DECIMAL(15,2)) AS DECIMAL(38,2)) AS quantity,
       item.bar_code AS item_bar_code, item.l_linenumber AS sort_code,
       'S' || record.l_suppkey AS manufacturer, strftime(record.l_shipdate, '%Y%m%d') AS batch_no,
       'T' || record.l_orderkey AS test_report_no, record.l_returnflag AS storage_place,
       CAST(record.l_linenumber AS VARCHAR) AS skill_card_no, CASE WHEN record.l_orderkey % 7 > 0 THEN 'ok' END AS remark
FROM item LEFT JOIN record ON item.bar_code = record.bar_code
ORDER BY sort_code
""", "J2,J7,P9,P10,P12,F8,T1")
def allot_receive(spark, sf_dir):
    t = tables(spark, sf_dir)
    li = t.lineitem
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    bar = F.concat_ws("-", ok.cast("string"), ln.cast("string"))
    name = F.concat(F.lit("material "), pk.cast("string"))
    model = F.concat(F.lit("M"), (pk % 50).cast("string"))
    allot = li.filter((F.col("l_returnflag") != "R") & name.like("%%") & model.like("%%")).select(
        (ok * 8 + ln).alias("id"), ok.alias("order_id"), pk.alias("material_id"), name.alias("material_name"),
        model.alias("material_model"), dec("l_quantity").alias("quantity"), bar.alias("item_bar_code"),
        ln.alias("sort_code"))
    received = li.filter((F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 3 > 0) & (F.col("l_tax") < 0.05)).select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("manufacturer"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("batch_no"),
        F.concat(F.lit("T"), ok.cast("string")).alias("test_report_no"), F.col("l_returnflag").alias("storage_place"),
        ln.cast("string").alias("skill_card_no"), ok.alias("b_order"), ln.alias("b_line"),
        F.when(ok % 7 == 0, F.lit(None)).otherwise(F.lit("ok")).alias("remark"))
    # the bar code 'order-line' of two non-negative integers is equal exactly
    # when both numbers are: join on them, not on the string
    out = allot.join(received, (F.col("order_id") == F.col("b_order")) & (F.col("sort_code") == F.col("b_line")),
                     "left").drop("b_order", "b_line")
    return out.orderBy("sort_code", "id")


# ---------------------------------------------------------------------------
# Day plan rates (J11, F11).  Rule: for every org (customer), with the plan
# of a period being its order amounts of the report date's month, quarter
# and year in units of ten thousand: the three plans, the month's per day,
# and the shares of the month's and year's days that have come, the report
# date included.  Money is summed as exact decimals and turned into doubles
# once, so both engines run the same floating-point operations.
_YEAR_DAYS = (AS_OF.replace(month=12, day=31) - AS_OF.replace(month=1, day=1)).days + 1
_MONTH_DAYS = (add_months(AS_OF.replace(day=1), 1) - AS_OF.replace(day=1)).days


@register("day_plan_rates", f"""
WITH plan AS (
    SELECT c_custkey AS org_id,
           CAST(coalesce(sum(amount) FILTER (m = {AS_OF.month}), 0) AS DOUBLE) / 10000 AS month_plan,
           CAST(coalesce(sum(amount) FILTER ((m + 2) // 3 = {(AS_OF.month + 2) // 3}), 0) AS DOUBLE) / 10000 AS quarter_plan,
           CAST(coalesce(sum(amount), 0) AS DOUBLE) / 10000 AS year_plan
    FROM customer LEFT JOIN (
        SELECT o_custkey, month(o_orderdate) AS m, CAST(o_totalprice AS DECIMAL(15,2)) AS amount
        FROM orders WHERE year(o_orderdate) = {AS_OF.year}) ON o_custkey = c_custkey
    GROUP BY c_custkey
)
SELECT org_id, month_plan / {_MONTH_DAYS} AS day_plan, month_plan, {AS_OF.day} / {_MONTH_DAYS} AS month_due, quarter_plan, year_plan,
       {AS_OF.timetuple().tm_yday} / {_YEAR_DAYS} AS year_due
FROM plan
""", "J11,J2,F11,F12,F13,F15,F16,A2,A6")
def day_plan_rates(spark, sf_dir):
    """The three joins to the month/quarter/year plan tables become one
    aggregate per org over the report year's orders (the year window
    reaches the scan): month, quarter and year are conditional sums."""
    t = tables(spark, sf_dir)
    d = F.lit(AS_OF)
    year_start = AS_OF.replace(month=1, day=1)
    od = F.col("o_orderdate")
    amt = dec("o_totalprice")
    per_org = (t.orders.filter((od >= ntz(year_start)) & (od < ntz(year_start.replace(year=AS_OF.year + 1))))
               .groupBy(F.col("o_custkey").alias("p_org")).agg(
                   F.sum(F.when(F.month(od) == AS_OF.month, amt)).alias("month_pv"),
                   F.sum(F.when(S.quarter_of_month(F.month(od)) == S.quarter_of_month(F.lit(AS_OF.month)), amt))
                   .alias("quarter_pv"),
                   F.sum(amt).alias("year_pv")))
    org = F.col("c_custkey")
    da = t.customer.select(
        org.alias("org_id"),
        F.concat(S.date_key(d), F.lit("-"), org.cast("string")).alias("id"),
        S.month_start(d).alias("stat_month_start"), F.dayofmonth(F.last_day(d)).alias("stat_month_day_count"),
        F.trunc(d, "year").alias("stat_year_start"),
        F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31))).alias("stat_year_day_count"))
    key = F.concat(F.replace(F.left(d.cast("string"), F.lit(10)), F.lit("-"), F.lit("")),
                   F.lit("-"), F.col("org_id").cast("string"))
    j = da.filter(F.col("id") == key).join(per_org, F.col("org_id") == F.col("p_org"), "left")

    def plan(c):
        return S.ifnull(c, F.lit(0).cast("decimal(25,2)")).cast("double") / 10000

    return j.select(
        "org_id",
        (plan("month_pv") / F.col("stat_month_day_count")).alias("day_plan"),
        plan("month_pv").alias("month_plan"),
        ((F.datediff(d, F.col("stat_month_start")) + 1) / F.col("stat_month_day_count")).alias("month_due"),
        plan("quarter_pv").alias("quarter_plan"),
        plan("year_pv").alias("year_plan"),
        ((F.datediff(d, F.col("stat_year_start")) + 1) / F.col("stat_year_day_count")).alias("year_due"))


# ---------------------------------------------------------------------------
# Category dosage summary (the production statements behind A10 and the
# CTE-embedding notes): planned and actual dosage per material from the
# orgs' production lines, plus audited supplement rows, summed per
# statistic category (categories chosen by a code list, materials mapped
# to them).  Categories = part brands; dosage = lines up to the report date.
# The statement's two line/order joins (dosage and supplement) are one
# join and one aggregate per material here (all arithmetic is exact in
# decimal): a joined row adds its dosage and supplement to its material,
# and a supplement row whose material falls back to 0 emits a second entry
# for material 0 (0 is a real part key in the driver tables).
CATEGORY_CODES = ("code_0", "code_1", "code_2", "code_3", "code_4")


@register("category_dosage", f"""
WITH orgs AS (SELECT c_custkey AS child_org_id FROM customer WHERE c_mktsegment = 'BUILDING'),
static_class AS (
    SELECT c.category_id, c.category_name, a.material_id
    FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS category_id, p_brand AS category_name,
                 'code_' || CAST(CAST(substr(p_brand, 7) AS INTEGER) % 7 AS VARCHAR) AS custome_code
          FROM part) c
    JOIN (SELECT p_partkey AS material_id, CAST(substr(p_brand, 7) AS INTEGER) AS statistic_id FROM part) a
      ON a.statistic_id = c.category_id
    WHERE c.custome_code IN {CATEGORY_CODES}
),
supplement_data AS (
    SELECT ifnull(CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE l.l_partkey END, 0) AS material_id,
           CAST(ifnull(CAST(l.l_extendedprice AS DECIMAL(15,2)) / 1000, 0) AS DECIMAL(28,8)) AS quantity
    FROM orders a JOIN lineitem l ON a.o_orderkey = l.l_orderkey
    WHERE a.o_custkey IN (SELECT child_org_id FROM orgs) AND a.o_orderpriority <> '5-LOW' AND a.o_orderstatus = 'F'
      AND l.l_shipdate <= TIMESTAMP '{AS_OF.isoformat()} 00:00:00' AND a.o_orderkey % 29 <> 0 AND l.l_linenumber <> 6
),
dosage_data AS (
    SELECT l.l_partkey AS material_id,
           CAST(ifnull(sum(CAST(l.l_quantity AS DECIMAL(15,2))), 0) / 1000 AS DECIMAL(28,8)) AS plan_amn,
           CAST(ifnull(sum(CAST(l.l_extendedprice AS DECIMAL(15,2))), 0) / 1000 AS DECIMAL(28,8)) AS fact_amnt
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN orgs ON o.o_custkey = orgs.child_org_id
    WHERE l.l_linenumber <> 7 AND l.l_shipdate <= TIMESTAMP '{AS_OF.isoformat()} 00:00:00'
    GROUP BY l.l_partkey
),
dosage AS (
    SELECT material_id, sum(plan_amn) AS plan_amn, sum(fact_amnt) AS fact_amnt
    FROM (SELECT material_id, plan_amn, fact_amnt FROM dosage_data
          UNION ALL
          SELECT material_id, quantity, quantity FROM supplement_data) a
    GROUP BY material_id
)
SELECT category_id AS statistic_class_id, ifnull(category_name, 'none') AS statistic_class_name,
       CAST(CAST(ifnull(sum(plan_amn), 0) AS DECIMAL(28,3)) AS DECIMAL(38,3)) AS plan_amn,
       CAST(CAST(ifnull(sum(fact_amnt), 0) AS DECIMAL(28,3)) AS DECIMAL(38,3)) AS fact_amnt
FROM static_class LEFT JOIN dosage ON dosage.material_id = static_class.material_id
GROUP BY category_id, category_name
ORDER BY category_id
""", "A10,A1,U1,J2,J7,F1,F5,P8,P12,T1")
def category_dosage(spark, sf_dir):
    t = tables(spark, sf_dir)
    orgs = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("child_org_id"))
    ok = F.col("o_orderkey")
    heads = t.orders.join(orgs, F.col("o_custkey") == F.col("child_org_id"), "left_semi").select(
        ok.alias("h_key"),
        ((F.col("o_orderpriority") != "5-LOW") & (F.col("o_orderstatus") == "F") & (ok % 29 != 0)).alias("supp_head"))
    ln = F.col("l_linenumber")
    lines = t.lineitem.filter(F.col("l_shipdate") <= ntz(AS_OF)).select(
        "l_orderkey", "l_partkey", dec("l_quantity").alias("q"), dec("l_extendedprice").alias("amt"),
        (ln != 7).alias("is_dosage"), (ln != 6).alias("supp_line"))
    j = lines.join(heads, F.col("l_orderkey") == F.col("h_key"))
    supp_amt = F.when(F.col("supp_head") & F.col("supp_line"), F.col("amt"))
    s_mat = F.when(F.col("l_orderkey") % 13 == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_partkey"))
    same = s_mat == F.col("l_partkey")
    none = F.lit(None).cast("decimal(15,2)")
    own = F.struct(F.col("l_partkey").alias("m"), F.when(F.col("is_dosage"), F.col("q")).alias("dq"),
                   F.when(F.col("is_dosage"), F.col("amt")).alias("da"), F.when(same, supp_amt).alias("sa"))
    fallback = F.struct(F.lit(0).cast("bigint").alias("m"), none.alias("dq"), none.alias("da"), supp_amt.alias("sa"))
    entries = F.when(~same & supp_amt.isNotNull(), F.array(own, fallback)).otherwise(F.array(own))
    e = j.select(F.explode(entries).alias("e")).select("e.*")
    per_material = e.groupBy(F.col("m").alias("material_id")).agg(
        F.sum("dq").alias("dq"), F.sum("da").alias("da"), F.sum("sa").alias("sa"))
    zero = F.lit(0).cast("decimal(25,2)")
    dosage = per_material.select(
        F.col("material_id").alias("d_material"),
        ((S.ifnull("dq", zero) + S.ifnull("sa", zero)) / 1000).alias("plan_amn"),
        ((S.ifnull("da", zero) + S.ifnull("sa", zero)) / 1000).alias("fact_amnt"))

    brand_id = F.substring(F.col("p_brand"), 7, 100).cast("int")
    static_class = t.part.select(brand_id.alias("category_id"), F.col("p_brand").alias("category_name"),
                                 F.col("p_partkey").alias("material_id")).filter(
        F.concat(F.lit("code_"), (F.col("category_id") % 7).cast("string")).isin(*CATEGORY_CODES))
    out = J.lookup_join(static_class, dosage, ["material_id"], ["d_material"], "left").groupBy(
        "category_id", "category_name").agg(
        S.ifnull(F.sum("plan_amn"), 0).cast("decimal(28,3)").alias("plan_amn"),
        S.ifnull(F.sum("fact_amnt"), 0).cast("decimal(28,3)").alias("fact_amnt"))
    return out.orderBy("category_id").select(
        F.col("category_id").alias("statistic_class_id"),
        S.ifnull("category_name", "none").alias("statistic_class_name"), "plan_amn", "fact_amnt")


# ---------------------------------------------------------------------------
# Month task report (the production statement behind J3 and the "add the
# org key to the big calendar join" note): every month task of a company
# with its calendar row (picked by its computed key), the daily reports of
# the company's in-hand top projects from the month start to the task date,
# the month plan, and the company's dispatch records over the same range.
# Companies = nations, projects = customers, tasks = one per company and
# month (dated at its last order day), daily reports / plan / dispatch =
# orders per customer-day / urgent orders per company-month / high-priority
# orders per company-day.
# Rule: a task per nation and month but February, dated at the nation's last
# order day of the month, if the nation has an in-hand project (customer key
# not a multiple of three, in credit) with an order in that year.  It reports
# the in-hand projects' amounts of the month, the urgent amounts, and the
# number and amount of the high-priority orders.
_TASK_SQL = """
WITH sold AS (
    SELECT c_nationkey AS nation, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y, month(o_orderdate) AS m,
           o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
           c_custkey % 3 <> 0 AND c_acctbal > 0 AS in_hand
    FROM orders JOIN customer ON c_custkey = o_custkey
), in_month AS (
    SELECT nation, y, m, max(d) AS last_day, sum(amount) FILTER (in_hand) AS done,
           sum(amount) FILTER (priority = '1-URGENT') AS urgent, sum(amount) FILTER (priority = '2-HIGH') AS high,
           nullif(count(*) FILTER (priority = '2-HIGH'), 0) AS highs
    FROM sold GROUP BY nation, y, m
)
SELECT CAST(nation AS BIGINT) * 1000000 + y * 100 + m AS id, nation AS org_id, 'e' || nation AS editor,
       'r' || nation % 4 AS reviewer, y AS stat_year, m AS stat_month, make_date(y, m, 1) AS stat_month_start,
       last_day AS stat_date, done AS complete_amount, urgent AS amount, highs AS plan_amount_other,
       high AS complete_amount_other
FROM in_month WHERE m <> 2 AND (nation, y) IN (SELECT (nation, y) FROM sold WHERE in_hand)
"""


@register("month_task_report", _TASK_SQL, "J3,J1,J2,J11,F12,F16,A1,A6,P6,P12,T1")
def month_task_report(spark, sf_dir):
    """Orders are aggregated once per customer and day and the result is
    checkpointed to the shared checkpoint folder: tasks, extras, daily
    reports, plan and dispatch all derive from it, and without the
    checkpoint each would re-scan orders and shuffle again (column pruning
    gives every consumer its own copy of the aggregate, so Spark cannot
    reuse one exchange).  A task's calendar row exists by construction (its
    date is an order day of its company), so its fields come from the date.
    The amounts are summed per company and day before they meet the tasks,
    and the two date-range joins are bucketed (31-day buckets): a day meets
    only the tasks whose month touches its bucket."""
    t = tables(spark, sf_dir)
    cust = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    od = F.col("o_orderdate").cast("date")
    amt = dec("o_totalprice")
    pr = F.col("o_orderpriority")
    day = (t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
           .groupBy("o_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal", od.alias("d"))
           .agg(F.sum(amt).alias("amount"), F.sum(F.when(pr == "1-URGENT", amt)).alias("urgent"),
                F.count(F.when(pr == "1-URGENT", 1)).alias("n_urgent"),
                F.sum(F.when(pr == "2-HIGH", amt)).alias("high"), F.count(F.when(pr == "2-HIGH", 1)).alias("n_high"))
           .checkpoint(eager=True))
    d = F.col("d")
    tasks = (day.groupBy("nation", F.year(d).alias("y"), F.month(d).alias("m")).agg(F.max(d).alias("stat_date"))
             .filter(F.col("m") != 2)
             .select((F.col("nation").cast("bigint") * 1000000 + F.col("y") * 100 + F.col("m")).cast("bigint").alias("id"),
                     F.col("nation").alias("org_id"),
                     F.concat(F.lit("e"), F.col("nation").cast("string")).alias("editor"),
                     F.concat(F.lit("r"), (F.col("nation") % 4).cast("string")).alias("reviewer"),
                     F.year("stat_date").cast("bigint").alias("stat_year"),
                     F.month("stat_date").cast("bigint").alias("stat_month"),
                     S.month_start("stat_date").alias("stat_month_start"), "stat_date"))
    in_hand = day.filter((F.col("o_custkey") % 3 != 0) & (F.col("c_acctbal") > 0))
    years = in_hand.select(F.col("nation").alias("org_id"), F.year(d).cast("bigint").alias("stat_year")).distinct()
    # facts = the in-hand projects' amounts per company and day, intervals =
    # [month start, task date]: no project ever meets a task
    daily = in_hand.groupBy(F.col("nation").alias("org_id"), F.col("d").alias("r_date")).agg(F.sum("amount").alias("r_amount"))
    j = J.range_join(daily, tasks, ["org_id"], "r_date", "stat_month_start", "stat_date", "inner", bucket=31)
    done = j.groupBy("id").agg(F.sum("r_amount").alias("complete_amount"))
    plan = day.filter(F.col("n_urgent") > 0).groupBy(
        F.col("nation").alias("p_org"), F.year(d).cast("bigint").alias("p_year"),
        F.month(d).cast("bigint").alias("p_month")).agg(F.sum("urgent").alias("amount"))
    temp = (tasks.join(years, ["org_id", "stat_year"], "left_semi")
            .join(done, "id", "left")
            .join(plan, (F.col("org_id") == F.col("p_org")) & (F.col("stat_year") == F.col("p_year"))
                  & (F.col("stat_month") == F.col("p_month")), "left")
            .drop("p_org", "p_year", "p_month"))
    dispatch = day.filter(F.col("n_high") > 0).groupBy(F.col("nation").alias("org_id"), F.col("d").alias("s_date")).agg(
        F.sum("n_high").cast("decimal(15,2)").alias("plan_amount"), F.sum("high").alias("s_amount"))
    k = J.range_join(dispatch, temp.select("id", "org_id", "stat_month_start", "stat_date"), ["org_id"], "s_date",
                     "stat_month_start", "stat_date", "inner", bucket=31)
    other = k.groupBy("id").agg(F.sum("plan_amount").alias("plan_amount_other"),
                                F.sum("s_amount").alias("complete_amount_other"))
    return (temp.join(other, "id", "left").orderBy(F.col("stat_date").desc(), "id")
            .select("id", "org_id", "editor", "reviewer", "stat_year", "stat_month", "stat_month_start", "stat_date",
                    "complete_amount", "amount", "plan_amount_other", "complete_amount_other"))
