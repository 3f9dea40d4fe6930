"""Aggregations, grouping sets and pivots."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.catalog.sql import CHARGE, DISC, PRICE, dbl, iso, money as sql_money
from sparrowmill.functions.columns import in_year
from sparrowmill.functions.exact import charged, discounted, mean, money, scaled
from sparrowmill.operators.aggregates import grouping_sets, pivot_table
from sparrowmill.operators.percentiles import percentile
from sparrowmill.registry import query

_TABLES = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")


@query("table_counts", "A01", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in _TABLES)
    + " UNION ALL SELECT 'partsupp', COUNT(*) FROM"
    " (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)")
def table_counts(t):
    counts = [
        getattr(t, n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for n in (*_TABLES, "partsupp")
    ]
    return reduce(DataFrame.unionByName, counts)


@query("group_count", "A02",
       "SELECT o_orderpriority, COUNT(*) AS num_orders FROM orders GROUP BY o_orderpriority")
def group_count(t):
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("num_orders"))


@query("agg_dict_sum", "A03", f"""
    SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty,
      {dbl(f'SUM({PRICE})')} AS sum_base_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_dict_sum(t):
    return (
        t.lineitem.withColumn("l_extendedprice", money("l_extendedprice"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg({"l_quantity": "sum", "l_extendedprice": "sum"})
        .withColumnsRenamed({"sum(l_quantity)": "sum_qty", "sum(l_extendedprice)": "sum_base_price"})
    )


@query("agg_dict_avg_join", "A03", f"""
    SELECT l_returnflag, o_orderpriority, AVG(l_quantity) AS avg_qty,
      {dbl(f'SUM({PRICE})')} / COUNT(*) AS avg_price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag, o_orderpriority""")
def agg_dict_avg_join(t):
    # Sums and counts per (order, flag) first: one row per order enters the join.
    per_order = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum(money("l_extendedprice")).alias("price"),
        F.count(F.lit(1)).alias("n"),
    )
    return (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_returnflag", "o_orderpriority")
        .agg(
            (F.sum("qty") / F.sum("n")).alias("avg_qty"),
            (F.sum("price").cast("double") / F.sum("n")).alias("avg_price"),
        )
    )


@query("agg_year_window", "A04", f"""
    SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS total_quantity,
      {dbl(f'SUM({PRICE})')} AS total_revenue
    FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01'
    GROUP BY l_returnflag, l_linestatus""")
def agg_year_window(t):
    return (
        t.lineitem.filter(in_year("l_shipdate", "1997-01-01"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("total_quantity"),
            F.sum(money("l_extendedprice")).alias("total_revenue"),
        )
    )


@query("order_revenue", "A05", f"""
    SELECT o_orderkey, {dbl(f'SUM({DISC})')} AS total_price_wo_tax
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def order_revenue(t):
    revenue = t.lineitem.groupBy("l_orderkey").agg(F.sum(discounted()).alias("total_price_wo_tax"))
    return t.orders.select("o_orderkey").join(
        revenue, F.col("l_orderkey") == F.col("o_orderkey")
    ).drop("l_orderkey")


@query("priority_thousands", "A06", f"""
    SELECT o_orderpriority,
      {dbl(f"round(SUM({sql_money('o_totalprice')}) * 0.001, 2)")} AS total_price_thousands
    FROM orders GROUP BY o_orderpriority""")
def priority_thousands(t):
    total = F.sum(money("o_totalprice"))
    return t.orders.groupBy("o_orderpriority").agg(
        scaled(total, "0.001").alias("total_price_thousands")
    )


@query("qty_by_supplier", "A07 L05", """
    SELECT l_suppkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey""")
def qty_by_supplier(t):
    return (
        t.lineitem.groupBy("l_suppkey")
        .agg(F.sum("l_quantity").alias("quantity"))
        .orderBy(F.desc("quantity"), "l_suppkey")
    )


@query("order_total_reconcile", "A08", f"""
    SELECT o_orderkey, {dbl('rebuilt')} AS rebuilt, {dbl(sql_money('o_totalprice'))} AS stored,
      {dbl(f"rebuilt - {sql_money('o_totalprice')}")} AS difference
    FROM orders JOIN (SELECT l_orderkey, CAST(round(SUM({CHARGE}), 2) AS DECIMAL(18,2)) AS rebuilt
      FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def order_total_reconcile(t):
    rebuilt = t.lineitem.groupBy("l_orderkey").agg(
        F.round(F.sum(charged()), 2).cast("decimal(18,2)").alias("rebuilt")
    )
    stored = t.order_totals.select("o_orderkey", F.col("total").alias("stored"))
    return stored.join(rebuilt, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "rebuilt", "stored", (F.col("rebuilt") - F.col("stored")).alias("difference")
    )


@query("grouping_sets", "A09", f"""
    SELECT ordermonth, customer_nation,
      {dbl("round(SUM(total) * 0.00001, 2)")} AS totalprice FROM (
      SELECT strftime(o_orderdate, '%Y-%-m') AS ordermonth, n_name AS customer_nation,
        {sql_money('o_totalprice')} AS total
      FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey)
    GROUP BY GROUPING SETS ((ordermonth), (customer_nation), (ordermonth, customer_nation))""")
def grouping_sets_report(t):
    # Month and customer first, then nation: each step combines map-side.
    monthly = t.order_totals.groupBy(
        "o_custkey", F.date_format("o_orderdate", "y-M").alias("ordermonth")
    ).agg(F.sum("total").alias("total"))
    rows = (
        monthly.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("ordermonth", F.col("n_name").alias("customer_nation"), "total")
    )
    sets = [["ordermonth"], ["customer_nation"], ["ordermonth", "customer_nation"]]
    total = scaled(F.sum("total"), "0.00001")
    return grouping_sets(rows, sets, {"totalprice": total}, value="total")


# Order priorities and the columns they pivot to.
PRIORITIES = {
    "1-URGENT": "urgent_order",
    "2-HIGH": "high_order",
    "3-MEDIUM": "medium_order",
    "4-NOT SPECIFIED": "not_specified_order",
    "5-LOW": "low_order",
}


@query("pivot_priority", "A10", f"""
    SELECT {iso('day')} AS orderdate, """ + ", ".join(
    f"{dbl(f'''MAX(total) FILTER (o_orderpriority = '{p}')''')} AS {c}"
    for p, c in PRIORITIES.items()) + f""" FROM (
      SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority,
        SUM({sql_money('o_totalprice')}) AS total FROM orders GROUP BY ALL)
    GROUP BY day""")
def pivot_priority(t):
    daily = t.order_totals.groupBy(
        F.to_date("o_orderdate").alias("orderdate"), "o_orderpriority"
    ).agg(F.sum("total").alias("total"))
    # One row per (day, priority), so the mean of the cell is the cell.
    return pivot_table(daily, ["orderdate"], "o_orderpriority", PRIORITIES, F.round(F.avg("total"), 2))


@query("count_distinct", "A11", """
    SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem
    GROUP BY l_returnflag""")
def count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("suppliers"))


@query("having_above_mean", "A12 A13", f"""
    SELECT o_custkey, {dbl('SUM(total)')} AS spend
    FROM (SELECT o_custkey, {sql_money('o_totalprice')} AS total FROM orders)
    GROUP BY o_custkey HAVING SUM(total) > 2 * (
      SELECT SUM({sql_money('o_totalprice')}) / COUNT(DISTINCT o_custkey) FROM orders)""")
def having_above_mean(t):
    spend = t.order_totals.groupBy("o_custkey").agg(F.sum("total").alias("spend"))
    average = spend.agg(mean(F.col("spend")).alias("average")).scalar()
    return spend.filter(F.col("spend").cast("double") > average * 2)


@query("approximate_median", "A14", f"""
    SELECT {iso('CAST(o_orderdate AS DATE)')} AS day, quantile_disc(o_totalprice, 0.5) AS median
    FROM orders GROUP BY 1""")
def approximate_median(t):
    daily = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_totalprice")
    return percentile(daily, ["day"], "o_totalprice", 0.5, "median")


@query("count_distribution", "A19", """
    SELECT lines, COUNT(*) AS orders FROM (
      SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY l_orderkey) GROUP BY lines""")
def count_distribution(t):
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return per_order.groupBy("lines").agg(F.count(F.lit(1)).alias("orders"))


@query("group_quarter_spend", "A16 A18", f"""
    SELECT {iso("date_trunc('quarter', o_orderdate)")} AS quarter, MAX(o_totalprice) AS top,
      {dbl(f"SUM({sql_money('o_totalprice')})")} AS spend,
      {dbl(f"SUM({sql_money('o_totalprice')})")} / COUNT(*) AS mean_spend
    FROM orders GROUP BY 1""")
def group_quarter_spend(t):
    return t.order_totals.groupBy(F.trunc("o_orderdate", "quarter").alias("quarter")).agg(
        F.max("o_totalprice").alias("top"),
        F.sum("total").alias("spend"),
        mean(F.col("total")).alias("mean_spend"),
    )
