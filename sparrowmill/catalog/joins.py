"""Joins of every kind and physical strategy."""

from pyspark.sql import functions as F

from sparrowmill.catalog.sql import DISC, dbl, iso, with_ctes
from sparrowmill.functions.exact import discounted
from sparrowmill.operators import joins
from sparrowmill.registry import query

_BAND = """o_orderkey = l_orderkey
      AND o_orderdate BETWEEN l_shipdate - INTERVAL 5 DAY AND l_shipdate + INTERVAL 5 DAY"""
_ON = {"o_orderkey": "l_orderkey"}
_NAMES = ("order_rows_count", "lineitem_rows_count")


@query("join_inner_band", "J01", f"""
    SELECT o_orderkey, l_orderkey, {iso('o_orderdate')} AS o_orderdate,
      {iso('l_shipdate')} AS l_shipdate FROM orders JOIN lineitem ON {_BAND}""")
def join_inner_band(t):
    lines = t.lineitem.select("l_orderkey", "l_shipdate")
    joined = joins.band_join(t.orders, lines, _ON, "o_orderdate", "l_shipdate", 5)
    return joined.select(
        "o_orderkey", "l_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
        F.to_date("l_shipdate").alias("l_shipdate"),
    )


def _counts(name, covers, how, sql_join):
    @query(name, covers, f"""
        SELECT COUNT(o_orderkey) AS order_rows_count, COUNT(l_orderkey) AS lineitem_rows_count
        FROM orders {sql_join} lineitem ON {_BAND}""")
    def build(t):
        # The benchmark defines both columns as dates; the files hold them as midnights.
        orders = t.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
        lines = t.lineitem.withColumn("l_shipdate", F.to_date("l_shipdate"))
        return joins.band_join_counts(
            orders, lines, _ON, "o_orderdate", "l_shipdate", 5, how, _NAMES
        )

    return build


join_inner_count = _counts("join_inner_count", "J02", "inner", "JOIN")
join_left_count = _counts("join_left_count", "J03", "left", "LEFT JOIN")
join_right_count = _counts("join_right_count", "J04", "right", "RIGHT JOIN")
join_full_count = _counts("join_full_count", "J05", "full", "FULL JOIN")


@query("join_cross", "J06", """
    SELECT n_name AS nation_name, r_name AS region_name FROM nation CROSS JOIN region""")
def join_cross(t):
    # The operator itself. The benchmark fixes both tables' sizes: 25 nations, 5 regions.
    return t.nation.crossJoin(t.region).select(
        F.col("n_name").alias("nation_name"), F.col("r_name").alias("region_name")
    )


@query("join_anti", "J07", """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
      SELECT * FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-01-01')""")
def join_anti(t):
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("date"))
    return joins.anti(t.customer.select("c_custkey", "c_name"), recent, {"c_custkey": "o_custkey"})


@query("self_join_same_week", "J08", """
    SELECT o1.o_custkey AS custkey, COUNT(*) AS pair_rows
    FROM orders o1 JOIN orders o2 ON o1.o_custkey = o2.o_custkey
      AND year(o1.o_orderdate) = year(o2.o_orderdate)
      AND week(o1.o_orderdate) = week(o2.o_orderdate)
    WHERE o1.o_orderkey <> o2.o_orderkey GROUP BY 1""")
def self_join_same_week(t):
    weeks = joins.self_pair_counts(
        t.orders,
        {
            "custkey": F.col("o_custkey"),
            "order_year": F.year("o_orderdate"),
            "order_week": F.weekofyear("o_orderdate"),
        },
        "o_orderkey",
    )
    return weeks.groupBy("custkey").agg(F.sum("pair_rows").alias("pair_rows"))


@query("join_column_name", "J09 J11", """
    SELECT c_custkey, n_nationkey AS nationkey, n_name, r_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey""")
def join_column_name(t):
    customer = t.customer.select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    nation = t.nation.select(
        F.col("n_nationkey").alias("nationkey"), "n_name", F.col("n_regionkey").alias("regionkey")
    )
    region = t.region.select(F.col("r_regionkey").alias("regionkey"), "r_name")
    return customer.join(nation, "nationkey", "left").join(region, "regionkey", "left").select(
        "c_custkey", "nationkey", "n_name", "r_name"
    )


@query("join_composite_key", "J10", with_ctes("partsupp", f"""
    SELECT ps_partkey, ps_suppkey, ps_availqty, {dbl('ps_supplycost')} AS ps_supplycost,
      SUM(l_quantity) AS shipped
    FROM partsupp JOIN lineitem ON l_partkey = ps_partkey AND l_suppkey = ps_suppkey
    GROUP BY 1, 2, 3, partsupp.ps_supplycost"""))
def join_composite_key(t):
    shipped = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("shipped"))
    on = (F.col("l_partkey") == F.col("ps_partkey")) & (F.col("l_suppkey") == F.col("ps_suppkey"))
    return t.partsupp.join(shipped, on).drop("l_partkey", "l_suppkey")


@query("join_semi", "J13", """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT * FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)""")
def join_semi(t):
    large = t.orders.filter(F.col("o_totalprice") > 490_000)
    return joins.semi(t.customer.select("c_custkey", "c_name"), large, {"c_custkey": "o_custkey"})


_STRATEGY_SQL = f"""
    SELECT s_name, l_linenumber, COUNT(*) AS lines, {dbl(f'SUM({DISC})')} AS total_price_wo_tax
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name, l_linenumber"""


def strategy_join(t, strategy):
    lines = t.lineitem.select("l_suppkey", "l_linenumber", discounted().alias("price"))
    suppliers = t.supplier.select("s_suppkey", "s_name")
    return joins.join_with_strategy(
        lines, suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "inner", strategy
    )


def _strategy(name, covers, strategy):
    @query(name, covers, _STRATEGY_SQL)
    def build(t):
        return (
            strategy_join(t, strategy)
            .groupBy("s_name", "l_linenumber")
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("price").alias("total_price_wo_tax"))
        )

    return build


join_strategy_broadcast = _strategy("join_strategy_broadcast", "J17", "broadcast")
join_strategy_merge = _strategy("join_strategy_merge", "J18", "merge")
join_strategy_shuffle_hash = _strategy("join_strategy_shuffle_hash", "J19", "shuffle_hash")


@query("join_non_equi", "J20", f"""
    SELECT s_suppkey, s_name, COUNT(*) AS lines, {dbl(f'SUM({DISC})')} AS total_price_wo_tax
    FROM lineitem JOIN supplier ON l_suppkey >= s_suppkey GROUP BY s_suppkey, s_name""")
def join_non_equi(t):
    return joins.totals_at_or_above(
        t.lineitem,
        "l_suppkey",
        t.supplier.select("s_suppkey", "s_name"),
        "s_suppkey",
        {"lines": F.count(F.lit(1)), "total_price_wo_tax": F.sum(discounted())},
        width=100_000,
    )


@query("join_cartesian", "J21", """
    SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def join_cartesian(t):
    on = F.col("n_regionkey") == F.col("r_regionkey")
    return joins.join_with_strategy(t.nation, t.region, on, "inner", "shuffle_replicate_nl").select(
        "n_name", "r_name"
    )
