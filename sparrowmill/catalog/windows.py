"""Window queries. Orders and months are dates, so they sort by time."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparrowmill.catalog.sql import PRICE, dbl, iso, money as sql_money
from sparrowmill.functions.columns import month_start
from sparrowmill.functions.exact import money, scaled
from sparrowmill.operators import windows
from sparrowmill.registry import query

# A line's place in its order: the shortest total order of lineitem.
LINE_ORDER = [(c, "asc") for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")]
_LINE_SQL = "l_linenumber, l_partkey, l_suppkey, l_shipdate"


def _lines(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return t.lineitem.select(*keys, money("l_extendedprice").alias("price"))


@query("win_running_sum", "W01", f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice AS price,
      {dbl(f'SUM({PRICE}) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)')}
        AS total_extendedprice FROM lineitem""")
def win_running_sum(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", money("l_extendedprice").alias("price"))
    return windows.ranked_and_running(
        lines, ["l_orderkey"], [("l_linenumber", "asc")], sums={"total_extendedprice": "price"},
    )


@query("win_prev2_sum", "W02", f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice AS price,
      {dbl(f'''SUM({PRICE}) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_SQL}
        ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)''')} AS total_prev_2_lineitems FROM lineitem""")
def win_prev2_sum(t):
    return windows.moving(
        _lines(t), ["l_orderkey"], LINE_ORDER, (-1, 0),
        {"total_prev_2_lineitems": F.sum("price")},
    ).select("l_orderkey", "l_linenumber", "price", "total_prev_2_lineitems")


def customer_months(t):
    """One row per customer and month with the exact order total."""
    monthly = t.order_totals.groupBy(
        "o_custkey", month_start("o_orderdate").alias("order_month")
    ).agg(F.sum("total").alias("total_price"))
    return monthly.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", F.col("c_name").alias("customer_name"), "order_month", "total_price"
    )


_MONTHS_SQL = f"""
    WITH monthly AS (
      SELECT c_custkey, c_name AS customer_name,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
        SUM({sql_money('o_totalprice')}) AS total_price
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
_ROWS_SQL = "(PARTITION BY c_custkey ORDER BY order_month ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"
_RANGE_SQL = ("(PARTITION BY c_custkey ORDER BY order_month RANGE BETWEEN INTERVAL 1 MONTH PRECEDING"
              " AND INTERVAL 1 MONTH FOLLOWING)")


def _mean_over(window):
    return F.sum("total_price").over(window).cast("double") / F.count("total_price").over(window)


def _three_rows():
    return Window.partitionBy("c_custkey").orderBy("order_month").rowsBetween(-1, 1)


@query("win_rows_avg", "W03", f"""{_MONTHS_SQL}
    SELECT customer_name, {iso('order_month')} AS order_month, {dbl('total_price')} AS total_price,
      {dbl(f'SUM(total_price) OVER {_ROWS_SQL}')} / COUNT(total_price) OVER {_ROWS_SQL}
        AS three_mo_total_price_avg
    FROM monthly""")
def win_rows_avg(t):
    # One row per customer and month: a group is as long as the calendar.
    return customer_months(t).withColumn(
        "three_mo_total_price_avg", _mean_over(_three_rows())
    ).drop("c_custkey")


@query("win_range_month", "W04", f"""{_MONTHS_SQL}
    SELECT customer_name, {iso('order_month')} AS order_month, {dbl('total_price')} AS total_price,
      {dbl(f'SUM(total_price) OVER {_ROWS_SQL}')} / COUNT(total_price) OVER {_ROWS_SQL} AS avg_3m_all,
      {dbl(f'SUM(total_price) OVER {_RANGE_SQL}')} / COUNT(total_price) OVER {_RANGE_SQL} AS avg_3m
    FROM monthly""")
def win_range_month(t):
    rows = customer_months(t).withColumn("avg_3m_all", _mean_over(_three_rows()))
    ranged = windows.moving_months(
        rows, ["c_custkey"], "order_month",
        {"range_sum": "sum(total_price)", "range_n": "count(total_price)"},
    )
    return ranged.select(
        "customer_name", "order_month", "total_price", "avg_3m_all",
        (F.col("range_sum").cast("double") / F.col("range_n")).alias("avg_3m"),
    )


@query("win_rank", "W05 F06", f"""
    SELECT o_custkey, o_orderkey, {iso('o_orderdate')} AS o_orderdate,
      format('{{:,.2f}}', o_totalprice) AS totalprice,
      CAST(RANK() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS BIGINT) AS rnk FROM orders""")
def win_rank(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    ranked = windows.ranked_and_running(
        orders, ["o_custkey"], [("o_totalprice", "desc")], rank="rnk",
    )
    return ranked.select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
        F.format_number("o_totalprice", 2).alias("totalprice"), "rnk",
    )


@query("win_rank_trio", "W06", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount,
      CAST(RANK() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC) AS BIGINT) AS rnk,
      CAST(DENSE_RANK() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC) AS BIGINT) AS dense_rnk,
      CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, {_LINE_SQL}) AS BIGINT)
        AS row_num
    FROM lineitem""")
def win_rank_trio(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_discount"
    )
    return windows.ranked_and_running(
        lines, ["l_orderkey"], [("l_discount", "desc")], rank="rnk", dense_rank="dense_rnk",
        row_number=("row_num", [("l_discount", "desc"), *LINE_ORDER]),
    ).drop("l_shipdate")


def monthly_orders(t):
    """One row per month: its first day, its text label and the total in hundred thousands."""
    return (
        t.order_totals.groupBy(month_start("o_orderdate").alias("month"))
        .agg(scaled(F.sum("total"), "0.00001").alias("total_price"))
        .withColumn("ordermonth", F.date_format("month", "y-M"))
    )


_MONTH_TOTALS = f"""
    WITH monthly AS (
      SELECT date_trunc('month', o_orderdate) AS month,
        strftime(date_trunc('month', o_orderdate), '%Y-%-m') AS ordermonth,
        round(SUM({sql_money('o_totalprice')}) * 0.00001, 2) AS total_price
      FROM orders GROUP BY 1, 2)"""


@query("win_lag_month", "W07 F13", f"""{_MONTH_TOTALS}
    SELECT ordermonth, {dbl('total_price')} AS total_price,
      {dbl('LAG(total_price) OVER (ORDER BY month)')} AS prev_month_total_price FROM monthly""")
def win_lag_month(t):
    return windows.period_change(
        monthly_orders(t), "month", "total_price", "prev_month_total_price"
    ).select("ordermonth", "total_price", "prev_month_total_price")


@query("period_over_period", "W08", f"""{_MONTH_TOTALS}
    SELECT ordermonth, {dbl('total_price')} AS totalprice,
      ({dbl('total_price')} - {dbl('LAG(total_price) OVER (ORDER BY month)')}) * 100
        / {dbl('LAG(total_price) OVER (ORDER BY month)')} AS mom_change_perc FROM monthly""")
def period_over_period(t):
    months = windows.period_change(monthly_orders(t), "month", "total_price")
    now, before = F.col("total_price").cast("double"), F.col("previous").cast("double")
    return months.select(
        "ordermonth", F.col("total_price").alias("totalprice"),
        ((now - before) * 100 / before).alias("mom_change_perc"),
    )


@query("running_customer_total", "W09", f"""
    SELECT c_name AS customer_name, {iso('o_orderdate')} AS o_orderdate,
      {dbl('SUM(total)')} AS total_price,
      {dbl('SUM(SUM(total)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate)')}
        AS cumulative_total_price
    FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
        {sql_money('o_totalprice')} AS total FROM orders) o
      JOIN customer ON o_custkey = c_custkey
    GROUP BY c_name, o_custkey, o.o_orderdate""")
def running_customer_total(t):
    totals = windows.running_daily(
        t.order_totals, ["o_custkey"], "o_orderdate", "order_day", {"total_price": F.sum("total")}
    )
    return totals.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("customer_name"), F.col("order_day").alias("o_orderdate"),
        "total_price", "cumulative_total_price",
    )


@query("dedupe_row_number", "W10", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def dedupe_row_number(t):
    twice = t.orders.unionAll(t.orders)
    return windows.dedupe(twice, ["o_orderkey"], [F.col("o_orderkey")]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )
