"""Reporting queries of the analytic workload on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareshift.functions import scalars as S
from wareshift.operators import aggregates as A
from wareshift.operators import changes as D
from wareshift.operators import joins as J
from wareshift.operators import windows as W
from wareshift.operators.changes import with_sequence
from wareshift.plans.common import AS_OF, dec, ntz, sql_date, stat_cycle, tables
from wareshift.plans.registry import register

C = stat_cycle()

# ---------------------------------------------------------------------------
# Flagship: plan against actual per nation.  Rule: with M the last complete
# month, a nation's order amounts of M, of M's quarter and of M's year up to
# the end of M; as plan, those of the whole year before and of its month M.
_M = C["month_start"]
PLAN_VS_ACTUAL_SQL = f"""
SELECT r_name, n_name,
       coalesce(sum(amount) FILTER (y = {_M.year - 1}), 0) AS year_plan,
       coalesce(sum(amount) FILTER (y = {_M.year} AND m <= {_M.month}), 0) AS year_amount,
       coalesce(sum(amount) FILTER (y = {_M.year} AND m BETWEEN {C["quarter_start"].month} AND {_M.month}), 0) AS quarter_amount,
       coalesce(sum(amount) FILTER (y = {_M.year - 1} AND m = {_M.month}), 0) AS month_plan,
       coalesce(sum(amount) FILTER (y = {_M.year} AND m = {_M.month}), 0) AS month_amount
FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN (
    SELECT c_nationkey, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(o_totalprice AS DECIMAL(15,2)) AS amount
    FROM orders JOIN customer ON c_custkey = o_custkey
) ON c_nationkey = n_nationkey
GROUP BY n_nationkey, n_name, r_name
"""

MEASURES = ["year_plan", "year_amount", "quarter_amount", "month_plan", "month_amount"]


@register("plan_vs_actual", PLAN_VS_ACTUAL_SQL, "F1,F12,J1,J2,P6,P12,A1,A2,A9")
def plan_vs_actual(spark, sf_dir):
    """One scan of orders (date window pushed to the scan), one partial
    aggregate per customer, one shuffle join to customer, then a tiny
    aggregate per nation joined to the dimension rows."""
    t = tables(spark, sf_dir)
    d = F.col("o_orderdate")

    def within(lo, hi_excl):
        return (d >= ntz(lo)) & (d < ntz(hi_excl))

    amount = dec("o_totalprice")
    windows = {
        "year_plan": within(C["prior_year_start"], C["year_start"]),
        "year_amount": within(C["year_start"], C["next_month_start"]),
        "quarter_amount": within(C["quarter_start"], C["next_month_start"]),
        "month_plan": within(C["prior_month_start"], C["prior_month_next"]),
        "month_amount": within(C["month_start"], C["next_month_start"]),
    }
    orders = t.orders.select("o_custkey", "o_orderdate", "o_totalprice").filter(
        within(C["prior_year_start"], C["next_month_start"])
    )
    per_cust = orders.groupBy("o_custkey").agg(*[F.sum(F.when(c, amount)).alias(n) for n, c in windows.items()])
    cust = t.customer.select("c_custkey", "c_nationkey")
    per_nation = (
        per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
        .groupBy("c_nationkey")
        .agg(*[F.sum(n).alias(n) for n in MEASURES])
    )
    dims = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))  # planner broadcasts by file size
    out = dims.join(per_nation, dims.n_nationkey == per_nation.c_nationkey, "left")
    zero = F.lit(0).cast("decimal(25,2)")
    return out.select("r_name", "n_name", *[S.ifnull(n, zero).alias(n) for n in MEASURES])


# ---------------------------------------------------------------------------
# Per customer year-, month-, cumulative-to-date totals at AS_OF.
@register("period_totals", f"""
SELECT o_custkey,
       sum(CASE WHEN CAST(o_orderdate AS DATE) >= DATE '{AS_OF.year}-01-01' THEN CAST(o_totalprice AS DECIMAL(15,2)) ELSE 0 END) AS ytd,
       sum(CASE WHEN CAST(o_orderdate AS DATE) >= {sql_date(AS_OF.replace(day=1))} THEN CAST(o_totalprice AS DECIMAL(15,2)) ELSE 0 END) AS mtd,
       sum(CAST(o_totalprice AS DECIMAL(15,2))) AS cumulative,
       CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(CASE WHEN CAST(o_orderdate AS DATE) > CAST({sql_date(AS_OF)} - INTERVAL 30 DAY AS DATE) THEN 1 ELSE 0 END) AS BIGINT) AS last_30d,
       CAST(datediff('day', max(CAST(o_orderdate AS DATE)), {sql_date(AS_OF)}) AS BIGINT) AS days_since_last,
       CAST(min(CAST(o_orderdate AS DATE)) + INTERVAL 1 YEAR AS DATE) AS first_anniversary
FROM orders
WHERE CAST(o_orderdate AS DATE) <= {sql_date(AS_OF)}
GROUP BY o_custkey
""", "A12,F13")
def period_totals(spark, sf_dir):
    t = tables(spark, sf_dir)
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice").filter(
        F.col("o_orderdate") < ntz(AS_OF + __import__("datetime").timedelta(days=1)))
    d = F.col("o_orderdate").cast("date")
    a = F.lit(AS_OF)
    amt = dec("o_totalprice")
    totals = A.period_totals(o, ["o_custkey"], "o_orderdate", amt, AS_OF)
    counts = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.when(d > F.date_sub(a, 30), 1).otherwise(0)).cast("bigint").alias("last_30d"),
        F.datediff(a, F.max(d)).cast("bigint").alias("days_since_last"),
        F.add_months(F.min(d), 12).alias("first_anniversary"),
    )
    return totals.join(counts, "o_custkey")


# ---------------------------------------------------------------------------
# Month calendar of the orders with previous/next month,
# date-digit key, and the previous month's totals joined on a computed key.
@register("prior_month_bounds", """
WITH m AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           CAST(count(*) AS BIGINT) AS orders,
           sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
    FROM orders GROUP BY 1
)
SELECT m.month_start,
       CAST(m.month_start - INTERVAL 1 MONTH AS DATE) AS prev_month_start,
       CAST(m.month_start + INTERVAL 1 MONTH AS DATE) AS next_month_start,
       CAST(m.month_start + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end,
       strftime(m.month_start, '%Y%m%d') AS date_key,
       make_date(CAST(year(m.month_start) AS INTEGER), CAST(month(m.month_start) AS INTEGER), 1) = m.month_start AS key_roundtrip,
       CAST(datediff('day', m.month_start, CAST(m.month_start + INTERVAL 1 MONTH AS DATE)) AS BIGINT) AS day_count,
       m.orders, m.total,
       p.total AS prev_total
FROM m LEFT JOIN m p ON p.month_start = CAST(m.month_start - INTERVAL 1 MONTH AS DATE)
""", "F13,F15,F16,F17,J11")
def prior_month_bounds(spark, sf_dir):
    t = tables(spark, sf_dir)
    m = t.orders.groupBy(S.month_start("o_orderdate").alias("month_start")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(dec("o_totalprice")).alias("total"))
    p = m.select(F.col("month_start").alias("p_month"), F.col("total").alias("prev_total"))
    j = m.join(p, S.prev_month_start("month_start") == F.col("p_month"), "left")
    ms = F.col("month_start")
    return j.select(
        "month_start",
        S.prev_month_start(ms).alias("prev_month_start"),
        S.next_month_start(ms).alias("next_month_start"),
        F.last_day(ms).alias("month_end"),
        S.date_key(ms).alias("date_key"),
        (S.month_date(F.year(ms), F.month(ms)) == ms).alias("key_roundtrip"),
        F.datediff(S.next_month_start(ms), ms).cast("bigint").alias("day_count"),
        "orders", "total", "prev_total",
    )


# ---------------------------------------------------------------------------
# Monthly order totals joined to a quarter frame on ceil(month/3).
@register("quarter_key_join", """
WITH monthly AS (
    SELECT CAST(year(o_orderdate) AS BIGINT) AS yr, CAST(month(o_orderdate) AS BIGINT) AS mon,
           CAST(count(*) AS BIGINT) AS orders, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
    FROM orders GROUP BY 1, 2
),
quarters AS (
    SELECT CAST(year(l_shipdate) AS BIGINT) AS yr, CAST(quarter(l_shipdate) AS BIGINT) AS qtr,
           sum(CAST(l_quantity AS DECIMAL(15,2))) AS ship_qty
    FROM lineitem GROUP BY 1, 2
)
SELECT m.yr, m.mon, q.qtr, m.orders, m.total, q.ship_qty,
       round(m.total, -3) AS total_k,
       CAST(floor(m.orders / 7) AS BIGINT) AS weeks_floor,
       CAST(ceil(m.orders / 7) AS BIGINT) AS weeks_ceil,
       CAST(m.orders % 7 AS BIGINT) AS rest
FROM monthly m JOIN quarters q ON q.yr = m.yr AND q.qtr = CAST(ceil(m.mon / 3) AS BIGINT)
""", "J11,F11")
def quarter_key_join(spark, sf_dir):
    t = tables(spark, sf_dir)
    monthly = t.orders.groupBy(
        F.year("o_orderdate").cast("bigint").alias("yr"), F.month("o_orderdate").cast("bigint").alias("mon")
    ).agg(F.count(F.lit(1)).alias("orders"), F.sum(dec("o_totalprice")).alias("total"))
    quarters = t.lineitem.groupBy(
        F.year("l_shipdate").cast("bigint").alias("q_yr"), F.quarter("l_shipdate").cast("bigint").alias("qtr")
    ).agg(F.sum(dec("l_quantity")).alias("ship_qty"))
    j = monthly.join(quarters, (F.col("q_yr") == F.col("yr")) & (F.col("qtr") == S.quarter_of_month("mon")))
    n = F.col("orders")
    return j.select(
        "yr", "mon", "qtr", "orders", "total", "ship_qty",
        F.round("total", -3).alias("total_k"),
        F.floor(n / 7).cast("bigint").alias("weeks_floor"),
        F.ceil(n / 7).cast("bigint").alias("weeks_ceil"),
        (n % 7).cast("bigint").alias("rest"),
    )


# ---------------------------------------------------------------------------
# Line items shipped within 30 days of their order (equi key + bounds).
@register("range_join_ship", """
SELECT o.o_orderpriority,
       CAST(count(*) AS BIGINT) AS lines,
       sum(CAST(l.l_quantity AS DECIMAL(15,2))) AS qty
FROM lineitem l JOIN orders o
  ON l.l_orderkey = o.o_orderkey
 AND l.l_shipdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL 30 DAY
GROUP BY o.o_orderpriority
""", "J3")
def range_join_ship(spark, sf_dir):
    t = tables(spark, sf_dir)
    li = t.lineitem.select(F.col("l_orderkey").alias("okey"), "l_shipdate", "l_quantity")
    o = t.orders.select(F.col("o_orderkey").alias("okey"), "o_orderpriority",
                        F.col("o_orderdate").alias("lo"),
                        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("hi"))
    j = J.range_join(li, o, ["okey"], "l_shipdate", "lo", "hi")
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.sum(dec("l_quantity")).alias("qty"))


# J1 six tables in a chain: lines, quantity and orders of each part brand
# per region, but for one brand and pending orders.
@register("six_table_chain", """
SELECT r_name AS region, p_brand AS brand, CAST(count(*) AS BIGINT) AS lines, sum(CAST(l_quantity AS DECIMAL(15,2))) AS qty,
       count(DISTINCT o_orderkey) AS orders
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
WHERE p_brand <> 'Brand#11' AND o_orderstatus <> 'P'
GROUP BY r_name, p_brand
""", "J1,A1,A5")
def six_table_chain(spark, sf_dir):
    t = tables(spark, sf_dir)
    # lines meet their part first and are summed per order and brand, so the
    # shuffle to the orders carries one row per order and brand
    part = t.part.filter(F.col("p_brand") != "Brand#11").select("p_partkey", F.col("p_brand").alias("brand"))
    lines = t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey", "brand").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(dec("l_quantity")).alias("qty"))
    orders = t.orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey")
    per_customer = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "brand").agg(
        F.sum("lines").alias("lines"), F.sum("qty").alias("qty"), F.count(F.lit(1)).alias("orders"))
    place = (t.customer.select("c_custkey", "c_nationkey")
             .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
             .join(t.region.select("r_regionkey", F.col("r_name").alias("region")), F.col("n_regionkey") == F.col("r_regionkey")))
    return per_customer.join(place, F.col("o_custkey") == F.col("c_custkey")).groupBy("region", "brand").agg(
        F.sum("lines").alias("lines"), F.sum("qty").alias("qty"), F.sum("orders").alias("orders"))


# J3, intervals of any length: an urgent order puts its customer on terms
# for 45 days, every third one for good (9999-12-31); all orders of the
# customer under each of its terms.
@register("range_join_open", """
SELECT t.o_orderkey AS terms, t.kind, CAST(count(*) AS BIGINT) AS orders,
       sum(CAST(o.o_totalprice AS DECIMAL(15,2))) AS amount, min(CAST(o.o_orderdate AS DATE)) AS first_day
FROM orders o JOIN (
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS since,
           CASE WHEN o_orderkey % 3 = 0 THEN 'open' ELSE 'closed' END AS kind,
           CASE WHEN o_orderkey % 3 = 0 THEN DATE '9999-12-31' ELSE CAST(o_orderdate AS DATE) + 45 END AS until
    FROM orders WHERE o_orderpriority = '1-URGENT'
) t ON t.o_custkey = o.o_custkey AND CAST(o.o_orderdate AS DATE) BETWEEN t.since AND t.until
GROUP BY t.o_orderkey, t.kind
""", "J3")
def range_join_open(spark, sf_dir):
    t = tables(spark, sf_dir)
    day = F.col("o_orderdate").cast("date")
    terms = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        "o_custkey", F.col("o_orderkey").alias("terms"), day.alias("since"),
        F.when(F.col("o_orderkey") % 3 == 0, "open").otherwise("closed").alias("kind"),
        F.when(F.col("o_orderkey") % 3 == 0, F.to_date(F.lit("9999-12-31"))).otherwise(F.date_add(day, 45)).alias("until"))
    # amounts per customer and day meet the terms, not single orders
    daily = t.orders.groupBy("o_custkey", day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(dec("o_totalprice")).alias("amount"))
    j = J.range_join(daily, terms, ["o_custkey"], "day", "since", "until", bucket=1)
    return j.groupBy("terms", "kind").agg(
        F.sum("n").alias("orders"), F.sum("amount").alias("amount"), F.min("day").alias("first_day"))


# OR / theta residual in ON (earlier years, or same year up to next month).
@register("or_theta_join", """
SELECT o.o_orderstatus, CAST(count(*) AS BIGINT) AS lines
FROM lineitem l JOIN orders o
  ON l.l_orderkey = o.o_orderkey
 AND (year(l.l_shipdate) < year(o.o_orderdate)
      OR (year(l.l_shipdate) = year(o.o_orderdate) AND month(l.l_shipdate) <= month(o.o_orderdate) + 1))
GROUP BY o.o_orderstatus
""", "J4")
def or_theta_join(spark, sf_dir):
    t = tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    ys, yo = F.year("l_shipdate"), F.year("o_orderdate")
    cond = (li.l_orderkey == o.o_orderkey) & (
        (ys < yo) | ((ys == yo) & (F.month("l_shipdate") <= F.month("o_orderdate") + 1)))
    return li.join(o, cond).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("lines"))


# ---------------------------------------------------------------------------
# Hierarchy roll-up region|nation|customer.  The textual prefix form
# LEFT(c.path, LENGTH(p.path)) = p.path also matches '1|1' against
# '1|16|...'; the path form matches whole segments only.
_NODES_SQL = """
nodes AS (
    SELECT CAST(r_regionkey AS VARCHAR) AS path, 1 AS level, r_regionkey AS rk FROM region
    UNION ALL
    SELECT CAST(n_regionkey AS VARCHAR) || '|' || CAST(n_nationkey AS VARCHAR), 2, n_regionkey FROM nation
    UNION ALL
    SELECT CAST(n.n_regionkey AS VARCHAR) || '|' || CAST(n.n_nationkey AS VARCHAR) || '|' || CAST(c.c_custkey AS VARCHAR), 3, n.n_regionkey
    FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""
_LEAF_SQL = """
leaf AS (
    SELECT CAST(n.n_regionkey AS VARCHAR) || '|' || CAST(n.n_nationkey AS VARCHAR) || '|' || CAST(c.c_custkey AS VARCHAR) AS path,
           sum(CAST(o.o_totalprice AS DECIMAL(15,2))) AS amount, count(*) AS cnt
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
    GROUP BY 1
)"""


def _nodes(t):
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select(F.col("r_regionkey").cast("string").alias("path"), F.lit(1).alias("level"),
                        F.col("r_regionkey").alias("rk"))
    nn = n.select(F.concat_ws("|", "n_regionkey", "n_nationkey").alias("path"), F.lit(2).alias("level"),
                  F.col("n_regionkey").alias("rk"))
    c = t.customer.select("c_custkey", "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    cc = c.select(F.concat_ws("|", "n_regionkey", "n_nationkey", "c_custkey").alias("path"), F.lit(3).alias("level"),
                  F.col("n_regionkey").alias("rk"))
    return r.unionByName(nn).unionByName(cc)


def _order_leaves(t):
    """Order totals per customer path; orders are aggregated per customer
    before the join so the shuffle carries one row per customer."""
    per_cust = t.orders.groupBy("o_custkey").agg(
        F.sum(dec("o_totalprice")).alias("amount"), F.count(F.lit(1)).alias("cnt"))
    n = t.nation.select("n_nationkey", "n_regionkey")
    c = t.customer.select("c_custkey", "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return per_cust.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat_ws("|", "n_regionkey", "n_nationkey", "c_custkey").alias("path"), "amount", "cnt")


def _rollup(spark, sf_dir, mode):
    t = tables(spark, sf_dir)
    out = J.ancestor_rollup(_order_leaves(t), "path", {"amount": F.sum("amount"), "cnt": F.sum("cnt")},
                            _nodes(t).drop("rk"), "path", mode=mode, leaf_unique=True)
    return out.select("path", "level",
                      F.coalesce("amount", F.lit(0).cast("decimal(25,2)")).alias("total"),
                      F.coalesce("cnt", F.lit(0)).cast("bigint").alias("orders"))


@register("ancestor_rollup", f"""
WITH {_NODES_SQL}, {_LEAF_SQL}
SELECT p.path, p.level, ifnull(sum(l.amount), 0) AS total, CAST(ifnull(sum(l.cnt), 0) AS BIGINT) AS orders
FROM nodes p LEFT JOIN leaf l ON left(l.path, length(p.path)) = p.path
GROUP BY p.path, p.level
""", "J5")
def ancestor_rollup(spark, sf_dir):
    return _rollup(spark, sf_dir, "string")


@register("ancestor_rollup_path", f"""
WITH {_NODES_SQL}, {_LEAF_SQL}
SELECT p.path, p.level, ifnull(sum(l.amount), 0) AS total, CAST(ifnull(sum(l.cnt), 0) AS BIGINT) AS orders
FROM nodes p LEFT JOIN leaf l ON l.path = p.path OR starts_with(l.path, p.path || '|')
GROUP BY p.path, p.level
""", "J5")
def ancestor_rollup_path(spark, sf_dir):
    return _rollup(spark, sf_dir, "path")


# J5 without aggregate: every customer with orders under each node whose
# path is a prefix of its own.
@register("ancestor_list", f"""
WITH {_NODES_SQL}, {_LEAF_SQL}
SELECT l.path AS customer, p.path AS ancestor, p.level, l.amount, CAST(l.cnt AS BIGINT) AS orders
FROM leaf l JOIN nodes p ON left(l.path, length(p.path)) = p.path
""", "J5")
def ancestor_list(spark, sf_dir):
    t = tables(spark, sf_dir)
    leaves = _order_leaves(t).withColumnRenamed("path", "customer")
    nodes = _nodes(t).select(F.col("path").alias("ancestor"), "level")
    return J.ancestor_join(leaves, nodes, "customer", "ancestor").select(
        "customer", "ancestor", "level", "amount", F.col("cnt").alias("orders"))


# Containment locate(p.path, c.path) > 0 inside the same region, for
# the customers that placed an urgent order.
@register("path_contains", f"""
WITH {_NODES_SQL},
picked AS (
    SELECT * FROM nodes WHERE level = 3 AND CAST(split_part(path, '|', 3) AS BIGINT) IN (
        SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
)
SELECT p.path, p.level, CAST(count(*) AS BIGINT) AS children
FROM nodes p JOIN picked c ON c.rk = p.rk AND strpos(c.path, p.path) > 0
GROUP BY p.path, p.level
""", "J6,F9")
def path_contains(spark, sf_dir):
    t = tables(spark, sf_dir)
    nodes = _nodes(t)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey"))
    picked = nodes.filter(F.col("level") == 3).join(
        urgent, F.split_part(F.col("path"), F.lit("|"), F.lit(3)).cast("bigint") == F.col("o_custkey"), "left_semi")
    c = picked.select(F.col("path").alias("c_path"), "rk")
    return J.containment_count(c, nodes, "c_path", "path", keys=["rk"]).select("path", "level", "children")


# ---------------------------------------------------------------------------
# Nested IN subqueries as semi joins.
@register("semi_in", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders
                    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49))
""", "J7")
def semi_in(spark, sf_dir):
    t = tables(spark, sf_dir)
    big = t.lineitem.filter(F.col("l_quantity") >= 49).select(F.col("l_orderkey"))
    o = J.semi(t.orders.select("o_orderkey", "o_custkey"), big, F.col("o_orderkey") == F.col("l_orderkey"))
    return J.semi(t.customer.select("c_custkey", "c_name"), o.select("o_custkey"),
                  F.col("c_custkey") == F.col("o_custkey"))


# Null-aware NOT IN (a null probe never qualifies).
@register("anti_not_in", """
SELECT c_custkey, c_name FROM customer
WHERE (CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END)
      NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
""", "J8")
def anti_not_in(spark, sf_dir):
    t = tables(spark, sf_dir)
    probe = t.customer.select("c_custkey", "c_name",
                              F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_custkey")).alias("probe"))
    sub = t.orders.filter(F.col("o_totalprice") > 300000).select("o_custkey")
    return J.anti_not_in(probe, sub, "probe", "o_custkey").select("c_custkey", "c_name")


# J8 on an empty list: every row qualifies, null probes included.
@register("anti_not_in_empty", """
SELECT c_custkey, c_name FROM customer
WHERE (CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END)
      NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 0)
""", "J8")
def anti_not_in_empty(spark, sf_dir):
    t = tables(spark, sf_dir)
    probe = t.customer.select("c_custkey", "c_name",
                              F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_custkey")).alias("probe"))
    sub = t.orders.filter(F.col("o_totalprice") < 0).select("o_custkey")
    return J.anti_not_in(probe, sub, "probe", "o_custkey").select("c_custkey", "c_name")


# Comma join of two one-row aggregates.
@register("cross_totals", """
SELECT a.order_total, a.order_count, b.line_qty, b.line_count
FROM (SELECT sum(CAST(o_totalprice AS DECIMAL(15,2))) AS order_total, CAST(count(*) AS BIGINT) AS order_count FROM orders) a,
     (SELECT sum(CAST(l_quantity AS DECIMAL(15,2))) AS line_qty, CAST(count(*) AS BIGINT) AS line_count FROM lineitem) b
""", "J9,A9")
def cross_totals(spark, sf_dir):
    t = tables(spark, sf_dir)
    a = t.orders.agg(F.sum(dec("o_totalprice")).alias("order_total"), F.count(F.lit(1)).alias("order_count"))
    b = t.lineitem.agg(F.sum(dec("l_quantity")).alias("line_qty"), F.count(F.lit(1)).alias("line_count"))
    return a.crossJoin(b)  # one row each by construction


# The latest order attached to every region (LEFT JOIN ... ON 1=1).
@register("attach_last", """
SELECT r.r_name, x.o_orderkey, x.o_orderdate
FROM region r LEFT JOIN (
    SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1
) x ON 1 = 1
""", "J10,T4")
def attach_last(spark, sf_dir):
    t = tables(spark, sf_dir)
    last = t.orders.select("o_orderkey", "o_orderdate").orderBy(
        F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(1)
    return J.attach_row(t.region.select("r_name"), last)


# ---------------------------------------------------------------------------
# Self join to the "original" customer of each nation (lowest key) with
# a CASE pick between the two rows.
@register("self_parent", """
WITH first AS (SELECT c_nationkey, min(c_custkey) AS orig_key FROM customer GROUP BY c_nationkey)
SELECT c.c_custkey, f.orig_key,
       CASE WHEN c.c_acctbal < o.c_acctbal THEN o.c_name ELSE c.c_name END AS pick_name,
       CASE WHEN c.c_custkey = f.orig_key THEN 'original' ELSE 'copy' END AS role
FROM customer c
JOIN first f ON f.c_nationkey = c.c_nationkey
JOIN customer o ON o.c_custkey = f.orig_key
""", "J12,F3")
def self_parent(spark, sf_dir):
    """The originals are one row per nation (semi-join of customers with the
    per-nation minimum); every customer meets its original on the nation
    key, which stays splittable for a big nation."""
    t = tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_name")
    first = c.groupBy("c_nationkey").agg(F.min("c_custkey").alias("orig_key"))
    orig = c.join(first, (c.c_custkey == first.orig_key) & (c.c_nationkey == first.c_nationkey), "left_semi").select(
        F.col("c_nationkey").alias("o_nation"), F.col("c_custkey").alias("orig_key"),
        F.col("c_acctbal").alias("o_bal"), F.col("c_name").alias("o_name"))
    j = J.lookup_join(c, orig, ["c_nationkey"], ["o_nation"], "inner")
    return j.select(
        "c_custkey", "orig_key",
        F.when(F.col("c_acctbal") < F.col("o_bal"), F.col("o_name")).otherwise(F.col("c_name")).alias("pick_name"),
        F.when(F.col("c_custkey") == F.col("orig_key"), "original").otherwise("copy").alias("role"),
    )


# Unit conversion through a de-duplicated factor table, 0/null -> 1.
@register("unit_convert", """
WITH factor AS (SELECT DISTINCT p_type, length(p_type) % 3 AS f FROM part),
q AS (
    SELECT p.p_type, sum(CAST(l.l_quantity AS DECIMAL(15,2))) AS qty
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_type
)
SELECT q.p_type, q.qty, CAST(coalesce(nullif(f.f, 0), 1) AS BIGINT) AS factor,
       round(q.qty / coalesce(nullif(f.f, 0), 1), 2) AS converted
FROM q LEFT JOIN factor f ON f.p_type = q.p_type
""", "J13")
def unit_convert(spark, sf_dir):
    t = tables(spark, sf_dir)
    part = t.part.select("p_partkey", "p_type")
    q = (t.lineitem.select("l_partkey", "l_quantity")
         .join(part, F.col("l_partkey") == F.col("p_partkey"))
         .groupBy("p_type").agg(F.sum(dec("l_quantity")).alias("qty")))
    factors = part.select("p_type", (F.length("p_type") % 3).alias("f")).distinct()
    out = J.convert_units(q.withColumn("amount", F.col("qty").cast("double")), factors, "p_type", "f", "amount",
                          "converted", factor_out="factor")
    return out.select("p_type", "qty", F.col("factor").cast("bigint").alias("factor"),
                      F.round("converted", 2).alias("converted"))


# Scalar subquery in a predicate.
@register("scalar_subquery", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS above_avg, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
GROUP BY o_orderstatus
""", "J14")
def scalar_subquery(spark, sf_dir):
    t = tables(spark, sf_dir)
    o = t.orders.select("o_orderstatus", "o_totalprice")
    average = o.agg(F.avg("o_totalprice")).scalar()
    return (o.filter(F.col("o_totalprice") > average)
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("above_avg"), F.sum(dec("o_totalprice")).alias("total")))


# Priority weights of the inline VALUES table.
PRIORITY_WEIGHTS = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]


# Inline VALUES table as a join side.
@register("values_join", """
SELECT w.priority, CAST(count(*) AS BIGINT) AS orders, sum(CAST(o.o_totalprice AS DECIMAL(15,2)) * w.weight) AS weighted
FROM orders o JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1)) AS w(priority, weight)
  ON w.priority = o.o_orderpriority
GROUP BY w.priority
""", "J15")
def values_join(spark, sf_dir):
    t = tables(spark, sf_dir)
    w = spark.createDataFrame(PRIORITY_WEIGHTS, "priority string, weight int")
    j = t.orders.select("o_orderpriority", "o_totalprice").join(F.broadcast(w), F.col("priority") == F.col("o_orderpriority"))
    return j.groupBy("priority").agg(F.count(F.lit(1)).alias("orders"),
                                     F.sum(dec("o_totalprice") * F.col("weight")).alias("weighted"))


# ---------------------------------------------------------------------------
# A3: pivot of two measures over linestatus values plus totals.
@register("pivot_flags", """
SELECT l_returnflag,
       sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(15,2)) END) AS qty_F,
       sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END) AS price_F,
       sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(15,2)) END) AS qty_O,
       sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END) AS price_O,
       sum(CAST(l_quantity AS DECIMAL(15,2))) AS qty_total,
       sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS price_total
FROM lineitem GROUP BY l_returnflag
""", "A3")
def pivot_flags(spark, sf_dir):
    t = tables(spark, sf_dir)
    li = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    return A.pivot_measures(li, ["l_returnflag"], "l_linestatus", ["F", "O"],
                            {"qty": F.col("l_quantity"), "price": F.col("l_extendedprice")}, money_scale=2)


# A2: signed sum and conditional sums.
@register("signed_sum", """
SELECT l_linestatus,
       sum(CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS DECIMAL(15,2)) ELSE CAST(l_quantity AS DECIMAL(15,2)) END) AS net_qty,
       sum(CASE WHEN l_discount * l_tax > 0 THEN CAST(l_quantity AS DECIMAL(15,2)) ELSE -CAST(l_quantity AS DECIMAL(15,2)) END) AS taxed_sign_qty,
       sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE 0 END) AS a_price
FROM lineitem GROUP BY l_linestatus
""", "A2")
def signed_sum(spark, sf_dir):
    t = tables(spark, sf_dir)
    q = dec("l_quantity")
    return t.lineitem.groupBy("l_linestatus").agg(
        A.signed_sum(q, F.col("l_returnflag") != "R").alias("net_qty"),
        A.signed_sum(q, F.col("l_discount") * F.col("l_tax") > 0).alias("taxed_sign_qty"),
        A.conditional_sum(dec("l_extendedprice"), F.col("l_returnflag") == "A").alias("a_price"),
    )


# Aggregate inside a condition vs its rewrite (the condition is grouped).
@register("if_agg", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS yr,
       CASE WHEN year(o_orderdate) >= 1998 THEN sum(CAST(o_totalprice AS DECIMAL(15,2))) ELSE 0 END AS if_of_sum,
       sum(CASE WHEN year(o_orderdate) >= 1998 THEN CAST(o_totalprice AS DECIMAL(15,2)) ELSE 0 END) AS sum_of_if
FROM orders GROUP BY year(o_orderdate)
""", "A11")
def if_agg(spark, sf_dir):
    t = tables(spark, sf_dir)
    y = F.year("o_orderdate")
    return t.orders.groupBy(y.cast("bigint").alias("yr")).agg(
        F.when(F.col("yr") >= 1998, F.sum(dec("o_totalprice"))).otherwise(F.lit(0)).alias("if_of_sum"),
        A.conditional_sum(dec("o_totalprice"), y >= 1998).alias("sum_of_if"),
    )


# A4, A5: group without aggregate = distinct.
@register("distinct_group", """
SELECT c_nationkey, c_mktsegment FROM customer GROUP BY c_nationkey, c_mktsegment
""", "A4,A5")
def distinct_group(spark, sf_dir):
    return tables(spark, sf_dir).customer.select("c_nationkey", "c_mktsegment").distinct()


# Group by an expression / output alias.
@register("group_expr", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS yr, substr(o_orderpriority, 1, 1) AS prio,
       CAST(count(*) AS BIGINT) AS orders
FROM orders GROUP BY yr, prio
""", "A6")
def group_expr(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("yr"),
                            F.substring("o_orderpriority", 1, 1).alias("prio")).agg(F.count(F.lit(1)).alias("orders"))


# HAVING without GROUP BY meant as a filter.
@register("having_filter", """
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(38,2)) AS price FROM orders WHERE o_totalprice > 450000
""", "A8")
def having_filter(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t.orders.filter(F.col("o_totalprice") > 450000).select("o_orderkey", "o_custkey", dec("o_totalprice").alias("price"))


# Group by ... having count(*) > 1 (duplicated line keys).
@register("having_dups", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""", "A7")
def having_dups(spark, sf_dir):
    t = tables(spark, sf_dir)
    return A.having_count(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 2)


# ---------------------------------------------------------------------------
# Zero-filled measure alignment with a type tag, then totals.
@register("union_tagged", """
SELECT kind, yr, sum(order_total) AS order_total, sum(line_qty) AS line_qty
FROM (
    SELECT 'order' AS kind, CAST(year(o_orderdate) AS BIGINT) AS yr, CAST(o_totalprice AS DECIMAL(15,2)) AS order_total, CAST(0 AS DECIMAL(15,2)) AS line_qty FROM orders
    UNION ALL
    SELECT 'line', CAST(year(l_shipdate) AS BIGINT), CAST(0 AS DECIMAL(15,2)), CAST(l_quantity AS DECIMAL(15,2)) FROM lineitem
) u GROUP BY kind, yr
""", "U1,U3")
def union_tagged(spark, sf_dir):
    from wareshift.operators.setops import tagged_union

    t = tables(spark, sf_dir)
    o = t.orders.select(F.year("o_orderdate").cast("bigint").alias("yr"), dec("o_totalprice").alias("order_total"))
    li = t.lineitem.select(F.year("l_shipdate").cast("bigint").alias("yr"), dec("l_quantity").alias("line_qty"))
    u = tagged_union({"order": o, "line": li}, ["order_total", "line_qty"], fill=F.lit(0).cast("decimal(15,2)"))
    return u.groupBy("kind", "yr").agg(F.sum("order_total").alias("order_total"), F.sum("line_qty").alias("line_qty"))


# A10: two-level aggregate over a union of sources.
@register("two_level", """
WITH u AS (
    SELECT 'cust' AS src, o_custkey AS k, CAST(o_totalprice AS DECIMAL(15,2)) AS amount FROM orders
    UNION ALL
    SELECT 'supp', l_suppkey, CAST(l_extendedprice AS DECIMAL(15,2)) FROM lineitem
), inner_agg AS (SELECT src, k, sum(amount) AS amount FROM u GROUP BY src, k)
SELECT src, sum(amount) AS amount, CAST(count(*) AS BIGINT) AS groups, max(amount) AS top_group FROM inner_agg GROUP BY src
""", "A10,U1")
def two_level(spark, sf_dir):
    t = tables(spark, sf_dir)
    o = t.orders.select(F.lit("cust").alias("src"), F.col("o_custkey").alias("k"), dec("o_totalprice").alias("amount"))
    li = t.lineitem.select(F.lit("supp").alias("src"), F.col("l_suppkey").alias("k"), dec("l_extendedprice").alias("amount"))
    return A.two_level([o, li], ["src", "k"], ["src"], "amount", top="top_group")


# Union of branches each with its own (ordered) limit and a constant.
@register("union_limited", """
(SELECT 'order' AS kind, o_orderkey AS k, CAST(o_totalprice AS DECIMAL(38,2)) AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
UNION ALL
(SELECT 'line' AS kind, l_orderkey AS k, CAST(l_extendedprice AS DECIMAL(38,2)) AS price FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey LIMIT 5)
""", "U2,T2")
def union_limited(spark, sf_dir):
    t = tables(spark, sf_dir)
    o = t.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5).select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("k"), dec("o_totalprice").alias("price"))
    li = t.lineitem.orderBy(F.col("l_extendedprice").desc(), "l_orderkey").limit(5).select(
        F.lit("line").alias("kind"), F.col("l_orderkey").alias("k"), dec("l_extendedprice").alias("price"))
    return o.union(li)


# ---------------------------------------------------------------------------
# Latest order per customer (ties -> higher order key).
@register("latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(38,2)) AS price FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rid FROM orders
) x WHERE rid = 1
""", "W1")
def latest_per_key(spark, sf_dir):
    t = tables(spark, sf_dir)
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    latest = W.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", dec("o_totalprice").alias("price"))


# Mixed asc/desc sort with explicit null ordering; the position in
# the order is part of the result.
@register("sort_mixed", """
SELECT o_orderkey, prio, CAST(o_totalprice AS DECIMAL(38,2)) AS price,
       CAST(row_number() OVER (ORDER BY prio ASC NULLS FIRST, o_totalprice DESC, o_orderkey) AS BIGINT) AS position
FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS prio FROM orders)
""", "T1,T7")
def sort_mixed(spark, sf_dir):
    t = tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_totalprice",
                        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("prio"))
    order = [F.col("prio").asc_nulls_first(), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    placed = with_sequence(o, "position", 1, order_by=order)
    return placed.select("o_orderkey", "prio", dec("o_totalprice").alias("price"), "position")


# Limit + offset.
@register("page_offset", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 40
""", "T2")
def page_offset(spark, sf_dir):
    t = tables(spark, sf_dir)
    return W.page(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], limit=20, offset=40)


# Offset without limit.
@register("offset_only", """
SELECT c_custkey, c_name FROM customer ORDER BY c_custkey OFFSET 100
""", "T3")
def offset_only(spark, sf_dir):
    t = tables(spark, sf_dir)
    return W.page(t.customer.select("c_custkey", "c_name"), ["c_custkey"], offset=100)


# Keyset page.
@register("keyset_page", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 100
""", "T6")
def keyset_page(spark, sf_dir):
    t = tables(spark, sf_dir)
    return W.keyset_page(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 1000, 100)


# T5: the 10 customers with most orders vs the rest.
@register("topk_tables", """
WITH sizes AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey),
top AS (SELECT o_custkey FROM sizes ORDER BY n DESC, o_custkey LIMIT 10)
SELECT s.o_custkey, s.n, CASE WHEN t.o_custkey IS NULL THEN 'rest' ELSE 'top' END AS pool
FROM sizes s LEFT JOIN top t ON t.o_custkey = s.o_custkey
""", "T5")
def topk_tables(spark, sf_dir):
    t = tables(spark, sf_dir)
    sizes = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    top, rest = W.top_k_and_rest(sizes, "n", 10, "o_custkey")
    return top.withColumn("pool", F.lit("top")).unionByName(rest.withColumn("pool", F.lit("rest")))


# ---------------------------------------------------------------------------
# Customers by segment vs customers with urgent orders in 1997.
_SET_A_SQL = "SELECT c_custkey AS k FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"
_SET_B_SQL = ("SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT' "
              "AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'")


def _sets(spark, sf_dir):
    t = tables(spark, sf_dir)
    a = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.col("c_custkey").alias("k"))
    b = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= ntz("1997-01-01 00:00:00"))
                        & (F.col("o_orderdate") < ntz("1998-01-01 00:00:00"))).select(F.col("o_custkey").alias("k"))
    return a, b


@register("set_intersect", f"{_SET_A_SQL} INTERSECT {_SET_B_SQL}", "U4")
def set_intersect(spark, sf_dir):
    from wareshift.operators.setops import names_intersect

    return names_intersect(*_sets(spark, sf_dir))


@register("set_difference", f"""
SELECT 'a_only' AS side, k FROM ({_SET_A_SQL} EXCEPT {_SET_B_SQL}) x
UNION ALL
SELECT 'b_only' AS side, k FROM ({_SET_B_SQL} EXCEPT {_SET_A_SQL}) y
""", "U5")
def set_difference(spark, sf_dir):
    from wareshift.operators.setops import names_difference

    a, b = _sets(spark, sf_dir)
    return (names_difference(a, b).select(F.lit("a_only").alias("side"), "k")
            .union(names_difference(b, a).select(F.lit("b_only").alias("side"), "k")))


@register("set_union_distinct", f"{_SET_A_SQL} UNION {_SET_B_SQL}", "U6")
def set_union_distinct(spark, sf_dir):
    from wareshift.operators.setops import names_union

    return names_union(*_sets(spark, sf_dir))


# ---------------------------------------------------------------------------
# decimal(28,3) casts, decimal difference, round/ceiling/floor/%.
@register("decimal_report", """
SELECT c_nationkey,
       sum(CAST(c_acctbal AS DECIMAL(28,3))) AS bal,
       sum(CAST(c_acctbal AS DECIMAL(28,3))) - sum(CAST(c_acctbal * 0 + 100 AS DECIMAL(28,3))) AS bal_less_fee,
       round(sum(CAST(c_acctbal AS DECIMAL(28,3))), 1) AS bal_r1,
       CAST(ceil(max(c_acctbal)) AS BIGINT) AS max_ceil,
       CAST(floor(min(c_acctbal)) AS BIGINT) AS min_floor,
       CAST(sum(CAST(c_custkey AS BIGINT) % 10) AS BIGINT) AS key_mod_sum
FROM customer GROUP BY c_nationkey
""", "F5,F11")
def decimal_report(spark, sf_dir):
    t = tables(spark, sf_dir)
    bal = F.col("c_acctbal").cast("decimal(28,3)")
    return t.customer.groupBy("c_nationkey").agg(
        F.sum(bal).alias("bal"),
        (F.sum(bal) - F.sum((F.col("c_acctbal") * 0 + 100).cast("decimal(28,3)"))).alias("bal_less_fee"),
        F.round(F.sum(bal), 1).alias("bal_r1"),
        F.ceil(F.max("c_acctbal")).cast("bigint").alias("max_ceil"),
        F.floor(F.min("c_acctbal")).cast("bigint").alias("min_floor"),
        F.sum(F.col("c_custkey") % 10).cast("bigint").alias("key_mod_sum"),
    )


# Text functions over every part row.
@register("text_funcs", """
SELECT p_partkey,
       concat(p_brand, '/', CAST(p_size AS VARCHAR)) AS brand_size,
       concat_ws('|', p_type, p_name, CAST(p_partkey AS VARCHAR)) AS path,
       left(p_name, 4) AS name4,
       CAST(length(p_name) AS BIGINT) AS name_len,
       CAST(strpos(p_name, ' ') AS BIGINT) AS space_at,
       replace(p_brand, 'Brand#', 'B') AS brand_short,
       trim('  ' || p_type || '  ') AS type_trim,
       split_part(p_name, ' ', 2) AS noun,
       regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants,
       regexp_extract(p_brand, '([0-9]+)', 1) AS brand_no,
       CAST(instr(p_type, 'A') AS BIGINT) AS a_at,
       CAST(p_size AS VARCHAR) AS size_text
FROM part
""", "F4,F8,F9,F10")
def text_funcs(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t.part.select(
        "p_partkey",
        F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("brand_size"),
        F.concat_ws("|", "p_type", "p_name", F.col("p_partkey").cast("string")).alias("path"),
        F.left("p_name", F.lit(4)).alias("name4"),
        F.length("p_name").cast("bigint").alias("name_len"),
        F.locate(" ", "p_name").cast("bigint").alias("space_at"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("brand_short"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit("  "))).alias("type_trim"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"),
        F.regexp_replace("p_name", "[aeiou]", "").alias("consonants"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("brand_no"),
        F.instr("p_type", "A").cast("bigint").alias("a_at"),
        F.col("p_size").cast("string").alias("size_text"),
    )


# if / searched CASE / simple CASE / nested CASE / nullvalue.
@register("case_forms", """
SELECT o_orderkey,
       CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END AS size_if,
       CASE WHEN o_totalprice > 400000 THEN 'xl' WHEN o_totalprice > 200000 THEN 'l' ELSE 'm' END AS size_band,
       CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'pending' END AS status_name,
       CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderpriority LIKE '1%' THEN 'open-urgent' ELSE 'open-other' END ELSE 'closed' END AS nested,
       (CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END) IS NULL AS prio_is_null
FROM orders
""", "F2,F3")
def case_forms(spark, sf_dir):
    t = tables(spark, sf_dir)
    p = F.col("o_totalprice")
    s = F.col("o_orderstatus")
    nullable_prio = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey",
        F.when(p > 250000, "big").otherwise("small").alias("size_if"),
        F.when(p > 400000, "xl").when(p > 200000, "l").otherwise("m").alias("size_band"),
        F.when(s == "F", "final").when(s == "O", "open").otherwise("pending").alias("status_name"),
        F.when(s == "O", F.when(F.col("o_orderpriority").like("1%"), "open-urgent").otherwise("open-other"))
        .otherwise("closed").alias("nested"),
        S.nullvalue(nullable_prio).alias("prio_is_null"),
    )


# lenient numeric casts over junk made by CASE over keys.
_RAW_PRICE_SQL = """CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
            WHEN o_orderkey % 11 = 1 THEN ''
            WHEN o_orderkey % 11 = 2 THEN CAST(o_totalprice AS VARCHAR) || 'x'
            ELSE CAST(o_totalprice AS VARCHAR) END"""


@register("lenient_double", f"""
SELECT o_orderstatus,
       CAST(count(TRY_CAST(raw AS DOUBLE)) AS BIGINT) AS parsed,
       CAST(sum(CASE WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS junk,
       sum(CAST(TRY_CAST(raw AS DOUBLE) AS DECIMAL(15,2))) AS total,
       CAST(count(TRY_CAST(key_text AS BIGINT)) AS BIGINT) AS keys_parsed
FROM (SELECT o_orderstatus, {_RAW_PRICE_SQL} AS raw,
             CASE WHEN o_orderkey % 5 = 0 THEN 'k' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS key_text
      FROM orders) x
GROUP BY o_orderstatus
""", "F6,F7")
def lenient_double(spark, sf_dir):
    t = tables(spark, sf_dir)
    k = F.col("o_orderkey")
    price_text = F.col("o_totalprice").cast("string")
    raw = (F.when(k % 11 == 0, "n/a").when(k % 11 == 1, "")
           .when(k % 11 == 2, F.concat(price_text, F.lit("x"))).otherwise(price_text))
    key_text = F.when(k % 5 == 0, F.concat(F.lit("k"), k.cast("string"))).otherwise(k.cast("string"))
    x = t.orders.select("o_orderstatus", S.lenient_double(raw).alias("v"), S.lenient_bigint(key_text).alias("kk"))
    return x.groupBy("o_orderstatus").agg(
        F.count("v").alias("parsed"),
        F.sum(F.when(F.col("v").isNull(), 1).otherwise(0)).cast("bigint").alias("junk"),
        F.sum(F.col("v").cast("decimal(15,2)")).alias("total"),
        F.count("kk").alias("keys_parsed"),
    )


# Malformed date texts seen in the source data (all must
# become null) and accepted loose forms.
JUNK_DATES = [
    "133406-03-22 00:00:00", "NaN-aN-aN aN:aN:aN", "Invalid date", "8-5-20", "10-1-81",
    "2013-7-1O", "6-30-07", "2022-05-30-2020-12-30",
]


def _raw_date_sql() -> str:
    whens = " ".join(f"WHEN event_id % 12 = {i} THEN '{v}'" for i, v in enumerate(JUNK_DATES))
    return (f"CASE {whens} WHEN event_id % 12 = 8 THEN NULL "
            "WHEN event_id % 12 = 9 THEN strftime(ts, '%Y-%-m-%-d') "
            "ELSE CAST(ts AS VARCHAR) END")


def _raw_date_col():
    e = F.col("event_id") % 12
    expr = None
    for i, v in enumerate(JUNK_DATES):
        expr = F.when(e == i, F.lit(v)) if expr is None else expr.when(e == i, F.lit(v))
    return (expr.when(e == 8, F.lit(None).cast("string"))
            .when(e == 9, F.date_format("ts", "yyyy-M-d"))
            .otherwise(F.col("ts").cast("string")))


# Lenient timestamps with a guard; junk -> null and flagged.
@register("lenient_dates", f"""
WITH r AS (SELECT event_id, {_raw_date_sql()} AS raw FROM events)
SELECT event_id, raw,
       CASE WHEN regexp_matches(trim(raw), '{S.DATE_GUARD}') THEN TRY_CAST(trim(raw) AS TIMESTAMP) END AS parsed,
       raw IS NOT NULL AND (CASE WHEN regexp_matches(trim(raw), '{S.DATE_GUARD}') THEN TRY_CAST(trim(raw) AS TIMESTAMP) END) IS NULL AS quarantined
FROM r
""", "D11,F6")
def lenient_dates(spark, sf_dir):
    t = tables(spark, sf_dir)
    r = t.events.select("event_id", _raw_date_col().alias("raw"))
    return r.select("event_id", "raw", S.lenient_timestamp("raw").alias("parsed"),
                    S.is_junk_timestamp("raw").alias("quarantined"))


# Rows with nulls in required columns are kept aside with the reason.
# D11 quarantine: the rows of junk dates, with what stands in them.
@register("date_quarantine", f"""
SELECT raw, CAST(count(*) AS BIGINT) AS rows, min(event_id) AS first_id
FROM (SELECT event_id, {_raw_date_sql()} AS raw, event_id % 12 AS kind FROM events) WHERE kind < 8 GROUP BY raw
""", "D11")
def date_quarantine(spark, sf_dir):
    rows = tables(spark, sf_dir).events.select("event_id", _raw_date_col().alias("raw"))
    _, junk = D.quarantine_dates(rows, "raw", "parsed")
    return junk.groupBy("raw").agg(F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"))


@register("not_null_quarantine", """
WITH x AS (
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS org_id,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS status,
           o_orderdate
    FROM orders
)
SELECT o_orderkey,
       CASE WHEN org_id IS NULL OR status IS NULL THEN 'rejected' ELSE 'good' END AS outcome,
       CASE WHEN org_id IS NULL AND status IS NULL THEN 'org_id is null, status is null'
            WHEN org_id IS NULL THEN 'org_id is null'
            WHEN status IS NULL THEN 'status is null' END AS reason
FROM x
""", "D10")
def not_null_quarantine(spark, sf_dir):
    from wareshift.operators.changes import enforce_not_null

    t = tables(spark, sf_dir)
    k = F.col("o_orderkey")
    x = t.orders.select(
        "o_orderkey",
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("org_id"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"),
    )
    good, bad = enforce_not_null(x, ["org_id", "status"])
    return (good.select("o_orderkey", F.lit("good").alias("outcome"), F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("o_orderkey", F.lit("rejected").alias("outcome"), F.col("reject_reason").alias("reason"))))


# comparison/AND/OR/NOT, IN list, BETWEEN, IS NULL, LIKE/RLIKE,
# aliases and constants.
@register("predicate_mix", """
SELECT c_custkey AS id, c_name AS name, 'cust' AS kind, c_acctbal > 5000 AS rich
FROM customer
WHERE (c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') OR c_acctbal BETWEEN 9000 AND 9500)
  AND NOT (c_nationkey = 3) AND c_nationkey <> 7 AND c_nationkey != 8
  AND c_name LIKE 'Customer#%' AND c_name NOT LIKE '%99'
  AND regexp_matches(lower(c_mktsegment), '^(auto|house|mach)')
  AND (CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END) IS NOT NULL
""", "P7,P8,P9,P10")
def predicate_mix(spark, sf_dir):
    t = tables(spark, sf_dir)
    c = t.customer
    cond = (
        (c.c_mktsegment.isin("AUTOMOBILE", "HOUSEHOLD") | c.c_acctbal.between(9000, 9500))
        & ~(c.c_nationkey == 3) & (c.c_nationkey != 7) & (c.c_nationkey != 8)
        & c.c_name.like("Customer#%") & ~c.c_name.like("%99")
        & F.lower(c.c_mktsegment).rlike("^(auto|house|mach)")
        & F.when(c.c_acctbal < 0, F.lit(None)).otherwise(c.c_acctbal).isNotNull()
    )
    return c.filter(cond).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                 F.lit("cust").alias("kind"), (F.col("c_acctbal") > 5000).alias("rich"))


# ---------------------------------------------------------------------------
# Month report status (W1 + J4 + J2).  Rule: an org (customer) has a report
# for each month with an order that is not pending.  Reported: how many it
# has up to the month after the report month and their order amounts; of its
# latest one the month and the amount without open orders; and the report
# month's amount.
REPORT_MONTH = (1998, 7)
_REPORT_K = REPORT_MONTH[0] * 12 + REPORT_MONTH[1] - 1

# an org's months, numbered through the years
_MONTHLY_SQL = """
monthly AS (
    SELECT o_custkey AS org, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS k, bool_or(o_orderstatus <> 'P') AS reported,
           sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total,
           coalesce(sum(CAST(o_totalprice AS DECIMAL(15,2))) FILTER (o_orderstatus = 'O'), 0) AS still_open
    FROM orders GROUP BY 1, 2
)"""


@register("month_report_status", f"""
WITH {_MONTHLY_SQL}
SELECT org AS org_id, count(*) FILTER (k <= {_REPORT_K} + 1) AS reports, sum(total) FILTER (k <= {_REPORT_K} + 1) AS contract_to_date,
       CAST(max(k) // 12 AS BIGINT) AS latest_year, CAST(max(k) % 12 + 1 AS BIGINT) AS latest_month,
       arg_max(total - still_open, k) AS total_amount, max(total) FILTER (k = {_REPORT_K}) AS this_month
FROM monthly JOIN customer ON c_custkey = org WHERE reported GROUP BY org
""", "W1,J2,J4,A2,P12")
def month_report_status(spark, sf_dir):
    """The month reports (one row per org and month, far fewer than the
    orders) feed three consumers -- latest report, earlier reports, this
    month's report -- so they are checkpointed to the shared folder and the
    orders are read once."""
    t = tables(spark, sf_dir)
    amt = dec("o_totalprice")
    rep = t.orders.groupBy(
        F.col("o_custkey").alias("org_id"), F.year("o_orderdate").cast("bigint").alias("yr"),
        F.month("o_orderdate").cast("bigint").alias("mon"),
    ).agg(F.sum(amt).alias("contract_amount"),
          A.conditional_sum(amt, F.col("o_orderstatus") == "O").alias("surplus_amount"),
          F.max(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1)).alias("status")).checkpoint(eager=True)
    ok = rep.filter(F.col("status") == 1)
    latest = W.latest_per_key(
        ok.select("org_id", "yr", "mon", (F.col("contract_amount") - F.col("surplus_amount")).alias("total_amount")),
        ["org_id"], ["yr", "mon"])
    y, m = REPORT_MONTH
    earlier = ok.filter((F.col("yr") < y) | ((F.col("yr") == y) & (F.col("mon") <= m + 1)))
    cust = t.customer.select(F.col("c_custkey").alias("org_id"))
    upto = cust.join(earlier, "org_id", "left").groupBy("org_id").agg(
        F.count("yr").alias("reports"), F.sum("contract_amount").alias("contract_to_date"))
    this = ok.filter((F.col("yr") == y) & (F.col("mon") == m)).select("org_id", F.col("contract_amount").alias("this_month"))
    return (upto.join(latest, "org_id").join(this, "org_id", "left")
            .select("org_id", "reports", "contract_to_date", F.col("yr").alias("latest_year"),
                    F.col("mon").alias("latest_month"), "total_amount", "this_month"))


# ---------------------------------------------------------------------------
# Material dosage report (shape of the production statement behind A3):
# production rows of one org's children left-joined to their dosage rows and
# grouped by an output alias, unioned with audited supplement rows (whose
# material key lacks the ' | ' separator, as in the original), then pivoted
# into plan/fact per line status with totals.
# Rule: of the orders of building customers, a line counts once with its
# quantity and price if the order is in the date window (an order without
# lines counts as one null line), under 'flag | status', and once more with
# its quantity as both if the order is finished, under 'flagstatus'.  Summed
# per order priority and that label, by line status and in all.
@register("material_pivot", """
WITH line AS (
    SELECT o_orderpriority AS pro_line, coalesce(l_returnflag, '') AS flag, l_linestatus AS status,
           CAST(l_quantity AS DECIMAL(28,3)) AS q, CAST(l_extendedprice AS DECIMAL(28,3)) AS price,
           o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00' AS in_window,
           o_orderstatus = 'F' AND l_orderkey IS NOT NULL AS finished
    FROM orders JOIN customer ON c_custkey = o_custkey AND c_mktsegment = 'BUILDING' LEFT JOIN lineitem ON l_orderkey = o_orderkey
), entry AS (
    SELECT pro_line, flag || ' | ' || coalesce(status, '') AS mater_info, status, q AS p, price AS f FROM line WHERE in_window
    UNION ALL
    SELECT pro_line, flag || status, status, q, q FROM line WHERE finished
)
SELECT pro_line, mater_info, sum(p) FILTER (status = 'F') AS plan_F, sum(f) FILTER (status = 'F') AS fact_F,
       sum(p) FILTER (status = 'O') AS plan_O, sum(f) FILTER (status = 'O') AS fact_O, sum(p) AS plan_total, sum(f) AS fact_total
FROM entry GROUP BY pro_line, mater_info
""", "A3,A6,A10,J2,F1,F5,F8,U1,P12")
def material_pivot(spark, sf_dir):
    """One pass over the org's orders and their lines: the final pivot sums
    everything per (line, material), so the production rows need no grouping
    of their own, and each joined row adds a production entry (orders in the
    date window; an order without lines adds its null row) and a supplement
    entry (finished orders, per line).  The statement joins orders to lines
    twice; this joins them once."""
    t = tables(spark, sf_dir)
    d3 = "decimal(28,3)"
    orgs = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("child_org_id"))
    od = F.col("o_orderdate")
    in_window = (od >= ntz("1996-01-01 00:00:00")) & (od <= ntz("1998-12-31 00:00:00"))
    heads = (t.orders.filter(in_window | (F.col("o_orderstatus") == "F"))
             .join(orgs, F.col("o_custkey") == F.col("child_org_id"), "left_semi")
             .select("o_orderkey", F.col("o_orderpriority").alias("pro_line"), in_window.alias("in_window"),
                     (F.col("o_orderstatus") == "F").alias("is_finished")))
    li = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    j = heads.join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    rf, ls = S.ifnull("l_returnflag", ""), S.ifnull("l_linestatus", "")
    produce = F.when(F.col("in_window"), F.struct(
        F.concat(rf, F.lit(" | "), ls).alias("mater_info"), F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast(d3).alias("plan_amn"), F.col("l_extendedprice").cast(d3).alias("fact_amnt")))
    q0 = S.ifnull("l_quantity", 0).cast(d3)
    supplement = F.when(F.col("is_finished") & F.col("l_orderkey").isNotNull(), F.struct(
        F.concat(rf, ls).alias("mater_info"), F.col("l_linestatus").alias("status"),
        q0.alias("plan_amn"), q0.alias("fact_amnt")))
    entries = F.filter(F.array(produce, supplement), lambda e: e.isNotNull())
    u = j.select("pro_line", F.explode(entries).alias("e")).select("pro_line", "e.*")
    return A.pivot_measures(u, ["pro_line", "mater_info"], "status", ["F", "O"],
                            {"plan": F.col("plan_amn"), "fact": F.col("fact_amnt")})


# ---------------------------------------------------------------------------
# Material balance (U3 + J13 + J9): receive / delivery / dosage measures
# aligned with zero fill and a type tag, converted through a de-duplicated
# unit-factor table (0 or null -> 1), totalled, and combined with the planned
# quantity -- two one-row aggregates joined by a comma join.
# Rule: a line's measure (quantity of returned and accepted lines, line number
# of the others) is divided by its part's unit factor, the length of the type
# modulo three, zero counting as one; a part's size likewise.
@register("material_balance", """
WITH unit AS (
    SELECT p_partkey, p_size, CASE WHEN length(p_type) % 3 = 0 THEN 1 ELSE length(p_type) % 3 END AS factor FROM part
), line AS (
    SELECT coalesce(sum(l_quantity / factor) FILTER (l_returnflag = 'R'), 0) AS returned,
           coalesce(sum(l_quantity / factor) FILTER (l_returnflag = 'A'), 0) AS accepted,
           coalesce(sum(l_linenumber / factor) FILTER (l_returnflag = 'N'), 0) AS used
    FROM lineitem JOIN unit ON p_partkey = l_partkey
)
SELECT round(returned, 0) AS receive_quantity, round(accepted, 0) AS mq_delivery_quantity, round(used, 0) AS fact_amnt,
       round((SELECT coalesce(sum(p_size / factor), 0) FROM unit), 0) AS plan_quantity,
       round(accepted + used, 0) AS delivery_quantity
FROM line
""", "J13,J9,A9,F1,F11")
def material_balance(spark, sf_dir):
    """The statement's receive / delivery / dosage sources are exclusive
    filters of the same lines, so the zero-filled union is one projection
    (one scan of the lines instead of three); the measures and rows are
    those of the union."""
    t = tables(spark, sf_dir)
    unit = t.part.select("p_partkey", F.col("p_type").alias("material_unit"))
    li = t.lineitem.select("l_partkey", "l_returnflag", "l_quantity", "l_linenumber").join(
        unit, F.col("l_partkey") == F.col("p_partkey"))
    flag = F.col("l_returnflag")
    zero = F.lit(0.0)
    allm = li.filter(flag.isin("R", "A", "N")).select(
        "material_unit",
        F.when(flag == "R", F.col("l_quantity")).otherwise(zero).alias("receive_quantity"),
        F.when(flag == "A", F.col("l_quantity")).otherwise(zero).alias("delivery_quantity"),
        F.when(flag == "N", F.col("l_linenumber").cast("double")).otherwise(zero).alias("fact_amnt"))
    measures = ["receive_quantity", "delivery_quantity", "fact_amnt"]
    factors = t.part.select(F.col("p_type").alias("conversion_unit"), (F.length("p_type") % 3).alias("f")).distinct()
    guarded = factors.select("conversion_unit", F.coalesce(F.when(F.col("f") != 0, F.col("f")), F.lit(1)).alias("conversion_factor"))
    conv = J.lookup_join(allm, guarded, ["material_unit"], ["conversion_unit"], "left")
    fct = S.ifnull("conversion_factor", 1)
    a = conv.agg(*[F.sum(F.col(m) / fct).alias(m) for m in measures])
    kl = J.lookup_join(t.part.select("p_type", "p_size"), guarded, ["p_type"], ["conversion_unit"], "left").agg(
        F.sum(F.col("p_size").cast("double") / fct).alias("plan_quantity"))
    z = lambda c: S.ifnull(c, 0)
    return a.crossJoin(kl).select(  # one row each by construction
        F.round(z("receive_quantity"), 0).alias("receive_quantity"),
        F.round(z("delivery_quantity"), 0).alias("mq_delivery_quantity"),
        F.round(z("fact_amnt"), 0).alias("fact_amnt"),
        F.round(z("plan_quantity"), 0).alias("plan_quantity"),
        F.round(z("delivery_quantity") + z("fact_amnt"), 0).alias("delivery_quantity"),
    )


# ---------------------------------------------------------------------------
# Month progress (A12 + T4/W1 + A3 + F3): this month's report per customer,
# the day after the last report of an earlier year (top-1 per key), a
# twelve-column monthly plan pivoted from the prior year, the month's plan
# picked by a simple CASE on the report month, and year/month/cumulative
# sums whose bounds come from the joined report rows.
# English month names used for the plan columns.

# Rule: for each org with a report for the report month, in units of ten
# thousand: the month's open amount, or if that is zero the amount of the
# same month a year before; its amounts since the month after its last
# report of an earlier year (all, if it has none), of the month, and of all
# months, each up to the report month's end.
_MONTH_PROGRESS_SQL = f"""
WITH {_MONTHLY_SQL}, placed AS (
    SELECT *, coalesce(max(k) FILTER (reported AND k // 12 < {REPORT_MONTH[0]}) OVER (PARTITION BY org), 0) AS last_before FROM monthly
)
SELECT org AS org_id,
       round(coalesce(nullif(sum(still_open) FILTER (k = {_REPORT_K}), 0), sum(total) FILTER (k = {_REPORT_K} - 12)) * 0.0001, 0) AS month_plan,
       round(coalesce(sum(total) FILTER (k > last_before AND k <= {_REPORT_K}), 0) * 0.0001, 0) AS since_last_year,
       round(sum(total) FILTER (k = {_REPORT_K}) * 0.0001, 0) AS month_done,
       round(sum(total) FILTER (k <= {_REPORT_K}) * 0.0001, 0) AS cumulative
FROM placed GROUP BY org HAVING bool_or(reported AND k = {_REPORT_K})
"""


@register("month_progress", _MONTH_PROGRESS_SQL, "A12,T4,W1,A3,F3,F1,F13,F15,J2,P7")
def month_progress(spark, sf_dir):
    """The month reports, the prior year's plan and the daily amounts all
    come from one aggregate of the orders per org and day (the open-order
    sum and the status flag combine across days, money is exact), which is
    checkpointed to the shared folder: orders are read once instead of once
    per consumer."""
    t = tables(spark, sf_dir)
    y, m = REPORT_MONTH
    amt = dec("o_totalprice")
    day = (t.orders.groupBy(F.col("o_custkey").alias("o_org"), F.col("o_orderdate").cast("date").alias("d")).agg(
        F.sum(amt).alias("amount"), A.conditional_sum(amt, F.col("o_orderstatus") == "O").alias("open_amount"),
        F.max(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1)).alias("not_pending"))
        .checkpoint(eager=True))
    rep = day.groupBy(
        F.col("o_org").alias("org_id"), F.year("d").cast("bigint").alias("yr"), F.month("d").cast("bigint").alias("mon"),
    ).agg(F.sum("open_amount").alias("surplus_amount"),
          F.max("not_pending").alias("status")).filter(F.col("status") == 1)
    start = S.month_date("yr", "mon")
    report = rep.filter((F.col("yr") == y) & (F.col("mon") == m)).select(
        "org_id", "mon", "surplus_amount", start.alias("stat_start"), F.last_day(start).alias("stat_end"))
    last = W.latest_per_key(rep.filter(F.col("yr") < y).select("org_id", "yr", "mon"), ["org_id"], ["yr", "mon"]).select(
        F.col("org_id").alias("l_org"), S.next_month_start(S.month_date("yr", "mon")).alias("l_start"))
    plan = A.pivot_measures(
        day.filter(F.year("d") == y - 1).select(
            F.col("o_org").alias("p_org"), F.month("d").alias("pm"), F.col("amount").alias("amt")),
        ["p_org"], "pm", list(range(1, 13)), {"plan": F.col("amt")}, totals=False)
    month_col = None
    for i in range(1, 13):
        c = F.col(f"plan_{i}")
        month_col = F.when(F.col("mon") == i, c) if month_col is None else month_col.when(F.col("mon") == i, c)
    # The orders grouped narrow (per org and day) before joining the report row.
    daily = day.select("o_org", "d", "amount")
    j = (report.join(last, F.col("l_org") == F.col("org_id"), "left")
         .join(plan, F.col("p_org") == F.col("org_id"), "left")
         .join(daily, F.col("o_org") == F.col("org_id"), "left"))
    d = F.col("d")
    lo_year = F.when(F.col("stat_start").isNull(), d).otherwise(S.ifnull("l_start", d))
    zero = F.lit(0)
    k = F.lit(0.0001).cast("decimal(5,4)")
    g = j.groupBy("org_id", "surplus_amount", "mon", *[f"plan_{i}" for i in range(1, 13)]).agg(
        F.sum(F.when((d >= lo_year) & (d <= F.col("stat_end")), F.col("amount")).otherwise(zero)).alias("s1"),
        F.sum(F.when((d >= S.ifnull("stat_start", d)) & (d <= F.col("stat_end")), F.col("amount")).otherwise(zero)).alias("s2"),
        F.sum(F.when(d <= F.col("stat_end"), F.col("amount")).otherwise(zero)).alias("s3"),
    )
    return g.select(
        "org_id",
        F.round(S.ifnull(F.nullif(F.col("surplus_amount"), F.lit(0)), month_col) * k, 0).alias("month_plan"),
        F.round(F.col("s1") * k, 0).alias("since_last_year"),
        F.round(F.col("s2") * k, 0).alias("month_done"),
        F.round(F.col("s3") * k, 0).alias("cumulative"),
    )
