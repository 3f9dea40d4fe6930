"""Scans, projections, filters, conditionals, sorting."""

from pyspark.sql import functions as F

from sparrowmill.catalog.sql import CHARGE, dbl, iso, with_ctes
from sparrowmill.functions.columns import bucketize
from sparrowmill.functions.exact import charged
from sparrowmill.operators.dml import insert_into
from sparrowmill.operators.joins import band_join
from sparrowmill.registry import query


@query("scan_parquet", "S02", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_parquet(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("project_columns", "P01", "SELECT o_orderkey, o_totalprice FROM orders")
def project_columns(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("filter_eq", "P02", "SELECT * FROM customer WHERE c_nationkey = 20")
def filter_eq(t):
    return t.customer.filter(F.col("c_nationkey") == 20)


@query("filter_and", "P03", "SELECT * FROM customer WHERE c_nationkey = 20 AND c_acctbal > 1000")
def filter_and(t):
    return t.customer.filter((F.col("c_nationkey") == 20) & (F.col("c_acctbal") > 1000))


@query("filter_or", "P04", "SELECT * FROM customer WHERE c_nationkey = 20 OR c_acctbal > 1000")
def filter_or(t):
    return t.customer.filter((F.col("c_nationkey") == 20) | (F.col("c_acctbal") > 1000))


@query("filter_nested", "P05", """SELECT * FROM customer
    WHERE (c_nationkey = 20 AND c_acctbal > 1000) OR c_nationkey = 11""")
def filter_nested(t):
    rich = (F.col("c_nationkey") == 20) & (F.col("c_acctbal") > 1000)
    return t.customer.filter(rich | (F.col("c_nationkey") == 11))


@query("filter_like", "P06 F08", """
    SELECT c_custkey, c_name, c_name LIKE '%381%' AS has_381, c_name LIKE '%381' AS ends_381,
      c_name LIKE 'Customer#00000%' AS starts_zero, c_name LIKE '%_91%' AS wildcard_91
    FROM customer
    WHERE c_name LIKE '%381%' OR c_name LIKE '%38' OR c_name LIKE 'Customer#0000000%'
      OR c_name LIKE '%_91%'""")
def filter_like(t):
    name = F.col("c_name")
    keep = (
        name.contains("381")
        | name.endswith("38")
        | name.startswith("Customer#0000000")
        | name.like("%_91%")
    )
    return t.customer.filter(keep).select(
        "c_custkey",
        "c_name",
        name.contains("381").alias("has_381"),
        name.endswith("381").alias("ends_381"),
        name.startswith("Customer#00000").alias("starts_zero"),
        name.like("%_91%").alias("wildcard_91"),
    )


@query("filter_in", "P07", """
    SELECT c_custkey, c_nationkey, c_nationkey IN (10, 20) AS listed FROM customer
    WHERE c_nationkey IN (10, 20) OR c_nationkey NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9)""")
def filter_in(t):
    nation = F.col("c_nationkey")
    return t.customer.filter(nation.isin(10, 20) | ~nation.isin(list(range(10)))).select(
        "c_custkey", "c_nationkey", nation.isin(10, 20).alias("listed")
    )


@query("case_bucket", "P08 P09 F19", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice > 100000 THEN 'high'
      WHEN o_totalprice BETWEEN 25000 AND 100000 THEN 'medium' ELSE 'low' END
      AS order_price_bucket FROM orders""")
def case_bucket(t):
    bands = [("medium", 25_000, 100_000), ("high", 100_000, None)]
    return t.orders.select(
        "o_orderkey",
        "o_totalprice",
        bucketize("o_totalprice", bands, "low").alias("order_price_bucket"),
    )


@query("coalesce_unmatched", "P10 F19", f"""
    SELECT o_orderkey, {iso('o_orderdate')} AS o_orderdate,
      COALESCE(l_orderkey, 9999999) AS lineitem_orderkey, {iso('l_shipdate')} AS l_shipdate
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
      AND o_orderdate BETWEEN l_shipdate - INTERVAL 5 DAY AND l_shipdate + INTERVAL 5 DAY
    WHERE lineitem.l_shipdate IS NULL""")
def coalesce_unmatched(t):
    """The orders that a left join leaves without a line, by the anti half of the band join alone."""
    lines = t.lineitem.select("l_orderkey", "l_shipdate")
    alone = band_join(
        t.orders, lines, {"o_orderkey": "l_orderkey"}, "o_orderdate", "l_shipdate", 5, "left_anti"
    )
    return alone.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.coalesce(F.lit(None).cast("bigint"), F.lit(9999999)).alias("lineitem_orderkey"),
        F.lit(None).cast("date").alias("l_shipdate"),
    )


@query("safe_cast_datediff", "P11 F09", """
    SELECT o_orderkey, CAST(date_diff('day', TRY_CAST(
      CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '1995-01-01' END AS DATE),
      CAST(o_orderdate AS DATE)) AS INTEGER) AS days FROM orders""")
def safe_cast_datediff(t):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise("1995-01-01")
    return t.orders.select(
        "o_orderkey", F.datediff("o_orderdate", text.try_cast("date")).alias("days")
    )


@query("line_total", "P14 P12", f"""
    SELECT l_orderkey, l_linenumber, {dbl(f'round({CHARGE}, 2)')} AS totalprice FROM lineitem""")
def line_total(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(charged(), 2).alias("totalprice")
    )


@query("topk_orders", "O01", f"""
    (SELECT 'low' AS side, o_custkey, o_orderkey, {iso('o_orderdate')} AS o_orderdate
     FROM orders ORDER BY o_custkey, o_orderkey LIMIT 10)
    UNION ALL
    (SELECT 'high', o_custkey, o_orderkey, {iso('o_orderdate')}
     FROM orders ORDER BY o_custkey DESC, o_orderkey LIMIT 10)""")
def topk_orders(t):
    def top(side, *order):
        return t.orders.orderBy(*order).limit(10).select(
            F.lit(side).alias("side"), "o_custkey", "o_orderkey",
            F.to_date("o_orderdate").alias("o_orderdate"),
        )

    return top("low", "o_custkey", "o_orderkey").unionAll(
        top("high", F.desc("o_custkey"), "o_orderkey")
    )


@query("sort_nulls_first", "O03", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, flagged FROM (
      SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS flagged FROM lineitem)
    ORDER BY flagged ASC NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey""")
def sort_nulls_first(t):
    flagged = F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return t.lineitem.select(*keys, flagged.alias("flagged")).orderBy(
        F.col("flagged").asc_nulls_first(), *keys
    )


@query("literal_rows", "S12 D08", """
    SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'hello'), (1, 'hello')) AS v(sample_key, sample_status)
    UNION ALL SELECT p_partkey, p_name FROM part""")
def literal_rows(t):
    rows = t.spark.createDataFrame(
        [(1, "hello"), (1, "hello")], "sample_key bigint, sample_status string"
    )
    return insert_into(rows, t.part.select("p_partkey", "p_name"))
