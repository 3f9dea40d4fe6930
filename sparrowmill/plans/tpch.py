"""The 22 benchmark queries as parameterised DataFrame functions.

Facts shrink to the join key before they are joined: the sum per order, per part or per supplier
is taken with a map-side combine, so a key that holds a large share of the lines enters the
shuffle once per task. Small sides carry no hint; Catalyst broadcasts them when they are small.
Money is decimal throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.functions.columns import in_year
from sparrowmill.functions.exact import charged, discounted, mean, money, rate
from sparrowmill.operators.joins import anti, semi
from sparrowmill.operators.skew import apart
from sparrowmill.sources.tables import Tables


def _eq(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def _suppliers(t: Tables, nations: Sequence[str] | None = None, region: str | None = None) -> DataFrame:
    """s_suppkey, s_nationkey and s_nation of suppliers, narrowed by nation or region."""
    nation = t.nation
    if region is not None:
        nation = nation.join(
            t.region.filter(F.col("r_name") == region), _eq("n_regionkey", "r_regionkey"), "left_semi"
        )
    if nations is not None:
        nation = nation.filter(F.col("n_name").isin(list(nations)))
    names = nation.select(F.col("n_nationkey").alias("s_nation_id"), F.col("n_name").alias("s_nation"))
    return t.supplier_x.join(names, _eq("s_nationkey", "s_nation_id")).drop("s_nation_id")


def q01(t: Tables, delta_days: int = 90, until: str = "2001-12-01") -> DataFrame:
    """Pricing summary of the lines shipped up to ``delta_days`` before ``until``."""
    last = F.date_sub(F.lit(until).cast("date"), delta_days)
    return (
        t.lineitem.filter(F.col("l_shipdate") <= last)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.sum(money("l_extendedprice")).alias("sum_base_price"),
            F.sum(discounted()).alias("sum_disc_price"),
            F.sum(charged()).alias("sum_charge"),
            F.avg("l_quantity").alias("avg_qty"),
            mean(money("l_extendedprice")).alias("avg_price"),
            mean(rate("l_discount")).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def q02(
    t: Tables, size: int = 15, type_suffix: str = "MEDIUM", region: str = "EUROPE", limit: int = 100
) -> DataFrame:
    """Cheapest suppliers of the region per part of a size and type."""
    parts = t.part_x.filter((F.col("p_size") == size) & F.col("p_type").endswith(type_suffix))
    offers = (
        t.partsupp.join(parts.select("p_partkey", "p_mfgr"), _eq("ps_partkey", "p_partkey"))
        .join(_suppliers(t, region=region), _eq("ps_suppkey", "s_suppkey"))
    )
    # The filter on the rank also limits each part's rows before they are shuffled.
    place = F.rank().over(Window.partitionBy("p_partkey").orderBy("ps_supplycost"))
    return (
        offers.withColumn("place", place).where("place = 1")
        .select("s_acctbal", "s_name", F.col("s_nation").alias("n_name"), "p_partkey", "p_mfgr", "s_comment")
        .orderBy(F.desc("s_acctbal"), "n_name", "s_name", "p_partkey")
        .limit(limit)
    )


def q03(t: Tables, segment: str = "BUILDING", date: str = "1995-03-15", limit: int = 10) -> DataFrame:
    """Unshipped orders of a segment with the highest revenue."""
    day = F.lit(date).cast("date")
    revenue = (
        t.lineitem.filter(F.col("l_shipdate") > day)
        .groupBy("l_orderkey")
        .agg(F.sum(discounted()).alias("revenue"))
    )
    customers = t.customer.filter(F.col("c_mktsegment") == segment)
    return (
        t.orders_x.filter(F.col("o_orderdate") < day)
        .join(customers, _eq("o_custkey", "c_custkey"), "left_semi")
        .join(revenue, _eq("o_orderkey", "l_orderkey"))
        .select("l_orderkey", "revenue", F.to_date("o_orderdate").alias("o_orderdate"), "o_shippriority")
        .orderBy(F.desc("revenue"), "o_orderdate", "l_orderkey")
        .limit(limit)
    )


def q04(t: Tables, date: str = "1996-07-01") -> DataFrame:
    """Orders of a quarter with a line received after its commit date, by priority."""
    late = t.lineitem_x.filter(F.col("l_commitdate") < F.col("l_receiptdate"))
    return (
        semi(t.orders.filter(in_year("o_orderdate", date, 3)), late, {"o_orderkey": "l_orderkey"})
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy("o_orderpriority")
    )


def q05(t: Tables, region: str = "ASIA", date: str = "1996-01-01") -> DataFrame:
    """Revenue per nation where supplier and customer share the nation."""
    per_order = (
        t.lineitem.join(_suppliers(t, region=region), _eq("l_suppkey", "s_suppkey"))
        .groupBy("l_orderkey", "s_nationkey", "s_nation")
        .agg(F.sum(discounted()).alias("revenue"))
    )
    return (
        t.orders.filter(in_year("o_orderdate", date))
        .join(per_order, _eq("o_orderkey", "l_orderkey"))
        .join(t.customer, _eq("o_custkey", "c_custkey") & _eq("s_nationkey", "c_nationkey"))
        .groupBy(F.col("s_nation").alias("n_name"))
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def q06(t: Tables, date: str = "1996-01-01", discount: float = 0.06, quantity: int = 24) -> DataFrame:
    """Revenue gained by dropping small discounts in a year."""
    # Bounds widened by half a step: the stored discounts are doubles.
    near = F.col("l_discount").between(discount - 0.015, discount + 0.015)
    return (
        t.lineitem.filter(in_year("l_shipdate", date) & near & (F.col("l_quantity") < quantity))
        .agg(F.sum(money("l_extendedprice") * rate("l_discount")).alias("revenue"))
    )


def q07(t: Tables, nation1: str = "NATION_6", nation2: str = "NATION_7") -> DataFrame:
    """Trade volume between two nations by year, both ways."""
    pair = [nation1, nation2]
    per_order = (
        t.lineitem.filter(in_year("l_shipdate", "1995-01-01", 24))
        .join(_suppliers(t, nations=pair), _eq("l_suppkey", "s_suppkey"))
        .groupBy(
            "l_orderkey",
            F.col("s_nation").alias("supp_nation"),
            F.year("l_shipdate").alias("l_year"),
        )
        .agg(F.sum(discounted()).alias("volume"))
    )
    buyers = t.customer.join(
        t.nation.filter(F.col("n_name").isin(pair)), _eq("c_nationkey", "n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("cust_nation"))
    return (
        per_order.join(t.orders, _eq("l_orderkey", "o_orderkey"))
        .join(buyers, _eq("o_custkey", "c_custkey"))
        .filter(F.col("supp_nation") != F.col("cust_nation"))
        .groupBy("supp_nation", "cust_nation", "l_year")
        .agg(F.sum("volume").alias("revenue"))
        .orderBy("supp_nation", "cust_nation", "l_year")
    )


def q08(
    t: Tables, nation: str = "NATION_7", region: str = "ASIA", part_type: str = "ECONOMY",
    use_decode: bool = False,
) -> DataFrame:
    """A nation's market share in a region for one part type, by year."""
    parts = t.part.filter(F.col("p_type") == part_type)
    per_order = (
        t.lineitem.join(parts, _eq("l_partkey", "p_partkey"), "left_semi")
        .join(_suppliers(t), _eq("l_suppkey", "s_suppkey"))
        .groupBy("l_orderkey", "s_nation")
        .agg(F.sum(discounted()).alias("volume"))
    )
    nations = t.nation.join(
        t.region.filter(F.col("r_name") == region), _eq("n_regionkey", "r_regionkey"), "left_semi"
    )
    buyers = t.customer.join(nations, _eq("c_nationkey", "n_nationkey"), "left_semi")
    if use_decode:
        zero = F.lit(0).cast("decimal(38,4)")
        own = F.call_function("decode", F.col("s_nation"), F.lit(nation),
                              F.col("volume").cast("decimal(38,4)"), zero)
    else:
        own = F.when(F.col("s_nation") == nation, F.col("volume")).otherwise(0)
    return (
        t.orders.filter(in_year("o_orderdate", "1995-01-01", 24))
        .join(buyers, _eq("o_custkey", "c_custkey"), "left_semi")
        .join(per_order, _eq("o_orderkey", "l_orderkey"))
        .groupBy(F.year("o_orderdate").alias("o_year"))
        .agg(
            (F.sum(own).cast("double") / F.sum("volume").cast("double")).alias("mkt_share")
        )
        .orderBy("o_year")
    )


def q09(t: Tables, word: str = "hot") -> DataFrame:
    """Profit by nation and year on the parts whose name holds a word."""
    parts = t.part.filter(F.col("p_name").contains(word))
    stock = apart(semi(t.partsupp, parts, {"ps_partkey": "p_partkey"}))
    profit = discounted() - F.col("ps_supplycost") * F.col("l_quantity").cast("decimal(4,0)")
    per_order = (
        semi(t.lineitem, parts, {"l_partkey": "p_partkey"})
        .join(stock, _eq("l_partkey", "ps_partkey") & _eq("l_suppkey", "ps_suppkey"))
        .join(_suppliers(t), _eq("l_suppkey", "s_suppkey"))
        .groupBy("l_orderkey", F.col("s_nation").alias("nation"))
        .agg(F.sum(profit).alias("profit"))
    )
    return (
        per_order.join(t.orders, _eq("l_orderkey", "o_orderkey"))
        .groupBy("nation", F.year("o_orderdate").alias("o_year"))
        .agg(F.sum("profit").alias("sum_profit"))
        .orderBy("nation", F.desc("o_year"))
    )


def q10(t: Tables, date: str = "1996-10-01", limit: int = 20) -> DataFrame:
    """Customers who lost the most revenue to returns in a quarter."""
    returned = (
        t.lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey")
        .agg(F.sum(discounted()).alias("revenue"))
    )
    per_customer = (
        t.orders.filter(in_year("o_orderdate", date, 3))
        .join(returned, _eq("o_orderkey", "l_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_customer.join(t.customer_x, _eq("o_custkey", "c_custkey"))
        .join(t.nation, _eq("c_nationkey", "n_nationkey"))
        .select("c_custkey", "c_name", "revenue", "c_acctbal", "n_name", "c_phone")
        .orderBy(F.desc("revenue"), "c_custkey")
        .limit(limit)
    )


def q11(t: Tables, nation: str = "NATION_7", fraction: str = "0.0001") -> DataFrame:
    """Parts holding more than a fraction of a nation's stock value."""
    value = F.sum(F.col("ps_supplycost") * F.col("ps_availqty"))
    stock = t.partsupp.join(_suppliers(t, nations=[nation]), _eq("ps_suppkey", "s_suppkey"))
    share = F.lit(fraction).cast("decimal(12,10)")
    # The total adds up the parts' values, from the same shuffle.
    parts = stock.groupBy("ps_partkey").agg(value.alias("value"))
    total = parts.agg(F.sum("value").alias("total")).scalar()
    return (
        parts.filter(F.col("value") > total * share)
        .orderBy(F.desc("value"), "ps_partkey")
    )


def q12(
    t: Tables, modes: Sequence[str] = ("MAIL", "SHIP"), date: str = "1996-01-01",
    use_decode: bool = False,
) -> DataFrame:
    """Late lines by ship mode, split by order priority."""
    per_order = (
        t.lineitem_x.filter(
            F.col("l_shipmode").isin(list(modes))
            & (F.col("l_commitdate") < F.col("l_receiptdate"))
            & (F.to_date("l_shipdate") < F.col("l_commitdate"))
            & in_year("l_receiptdate", date)
        )
        .groupBy("l_orderkey", "l_shipmode")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if use_decode:
        urgent = F.call_function(
            "decode", F.col("o_orderpriority"), F.lit("1-URGENT"), F.lit(1),
            F.lit("2-HIGH"), F.lit(1), F.lit(0),
        )
        is_urgent = urgent == 1
    else:
        is_urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        per_order.join(t.orders, _eq("l_orderkey", "o_orderkey"))
        .groupBy("l_shipmode")
        .agg(
            F.sum(F.when(is_urgent, F.col("n")).otherwise(0)).alias("high_line_count"),
            F.sum(F.when(is_urgent, 0).otherwise(F.col("n"))).alias("low_line_count"),
        )
        .orderBy("l_shipmode")
    )


def q13(t: Tables, word1: str = "special", word2: str = "requests") -> DataFrame:
    """How many customers have how many orders, leaving out orders with a comment pattern."""
    per_customer = (
        t.orders_x.filter(~F.col("o_comment").like(f"%{word1}%{word2}%"))
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("orders"))
    )
    return (
        t.customer.join(per_customer, _eq("c_custkey", "o_custkey"), "left")
        .groupBy(F.coalesce("orders", F.lit(0)).alias("c_count"))
        .agg(F.count(F.lit(1)).alias("custdist"))
        .orderBy(F.desc("custdist"), F.desc("c_count"))
    )


def q14(t: Tables, date: str = "1995-09-01", use_decode: bool = False) -> DataFrame:
    """Percentage of a month's revenue from promotion parts."""
    per_part = (
        t.lineitem.filter(in_year("l_shipdate", date, 1))
        .groupBy("l_partkey")
        .agg(F.sum(discounted()).alias("revenue"))
    )
    if use_decode:
        exact = F.col("revenue").cast("decimal(38,4)")
        promo = F.call_function("decode", F.substring("p_type", 1, 5), F.lit("PROMO"), exact,
                                F.lit(0).cast("decimal(38,4)"))
    else:
        promo = F.when(F.col("p_type").startswith("PROMO"), F.col("revenue")).otherwise(0)
    return per_part.join(t.part, _eq("l_partkey", "p_partkey")).agg(
        (F.lit(100.0) * F.sum(promo).cast("double") / F.sum("revenue").cast("double")).alias(
            "promo_revenue"
        )
    )


def q15(t: Tables, date: str = "1996-01-01") -> DataFrame:
    """Suppliers with the highest revenue of a quarter."""
    revenue = (
        t.lineitem.filter(in_year("l_shipdate", date, 3))
        .groupBy("l_suppkey")
        .agg(F.sum(discounted()).alias("total_revenue"))
    )
    top = revenue.agg(F.max("total_revenue").alias("top")).scalar()
    return (
        revenue.filter(F.col("total_revenue") == top)
        .join(t.supplier, _eq("l_suppkey", "s_suppkey"))
        .select("s_suppkey", "s_name", "total_revenue")
        .orderBy("s_suppkey")
    )


def q16(
    t: Tables, brand: str = "Brand#5", type_prefix: str = "MEDIUM",
    sizes: Sequence[int] = (49, 14, 23, 45, 19, 3, 36, 9),
) -> DataFrame:
    """Suppliers per brand, type and size, without those that drew complaints."""
    parts = t.part.filter(
        (F.col("p_brand") != brand)
        & ~F.col("p_type").startswith(type_prefix)
        & F.col("p_size").isin(list(sizes))
    )
    complaints = t.supplier_x.filter(F.col("s_comment").like("%Customer%Complaints%"))
    return (
        anti(t.partsupp, complaints, {"ps_suppkey": "s_suppkey"}, null_aware=True)
        .join(parts, _eq("ps_partkey", "p_partkey"))
        .groupBy("p_brand", "p_type", "p_size")
        .agg(F.countDistinct("ps_suppkey").alias("supplier_cnt"))
        .orderBy(F.desc("supplier_cnt"), "p_brand", "p_type", "p_size")
    )


def q17(t: Tables, brand: str = "Brand#23", container: str = "MED BOX") -> DataFrame:
    """Average yearly revenue of the lines below a fifth of their part's mean quantity."""
    parts = t.part_x.filter((F.col("p_brand") == brand) & (F.col("p_container") == container))
    # A part has few distinct quantities, however many lines it has.
    by_quantity = (
        semi(t.lineitem, parts, {"l_partkey": "p_partkey"})
        .groupBy("l_partkey", "l_quantity")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("price"))
    )
    limits = by_quantity.groupBy(F.col("l_partkey").alias("m_partkey")).agg(
        (F.lit(0.2) * (F.sum(F.col("l_quantity") * F.col("n")) / F.sum("n"))).alias("limit")
    )
    return (
        by_quantity.join(limits, _eq("l_partkey", "m_partkey") & (F.col("l_quantity") < F.col("limit")))
        .agg((F.sum("price").cast("double") / 7.0).alias("avg_yearly"))
    )


def q18(t: Tables, quantity: int = 300, limit: int = 100) -> DataFrame:
    """Customers with orders above a total quantity."""
    large = (
        t.lineitem.groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("sum_qty"))
        .filter(F.col("sum_qty") > quantity)
    )
    return (
        t.orders.join(large, _eq("o_orderkey", "l_orderkey"))
        .join(t.customer, _eq("o_custkey", "c_custkey"))
        .select(
            "c_name", "c_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
            "o_totalprice", "sum_qty",
        )
        .orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey")
        .limit(limit)
    )


# Containers of the three part blocks of q19, and their largest part sizes.
Q19_BLOCKS = (
    (("SM CASE", "SM BOX", "SM PACK", "SM PKG"), 5),
    (("MED BAG", "MED BOX", "MED PKG", "MED PACK"), 10),
    (("LG CASE", "LG BOX", "LG PACK", "LG PKG"), 15),
)


def q19(
    t: Tables,
    brands: Sequence[str] = ("Brand#12", "Brand#23", "Brand#4"),
    quantities: Sequence[int] = (1, 10, 20),
    width: int = 30,
) -> DataFrame:
    """Revenue of lines that fit one of three combinations of brand, container, size and quantity."""
    wanted_part, wanted_line, fits = F.lit(False), F.lit(False), F.lit(False)
    for brand, low, (containers, size) in zip(brands, quantities, Q19_BLOCKS):
        part = (
            (F.col("p_brand") == brand)
            & F.col("p_container").isin(list(containers))
            & F.col("p_size").between(1, size)
        )
        line = F.col("l_quantity").between(low, low + width)
        wanted_part, wanted_line, fits = wanted_part | part, wanted_line | line, fits | (part & line)
    lines = (
        t.lineitem_x.filter(
            wanted_line
            & F.col("l_shipmode").isin("AIR", "AIR REG")
            & (F.col("l_shipinstruct") == "DELIVER IN PERSON")
        )
        .groupBy("l_partkey", "l_quantity")
        .agg(F.sum(discounted()).alias("revenue"))
    )
    parts = t.part_x.filter(wanted_part)
    return lines.join(parts, _eq("l_partkey", "p_partkey") & fits).agg(
        F.sum("revenue").alias("revenue")
    )


def q20(
    t: Tables, word: str = "hot", date: str = "1996-01-01", nation: str = "NATION_3"
) -> DataFrame:
    """Suppliers of a nation with more stock than half a year's shipments of some matching part."""
    parts = t.part.filter(F.col("p_name").startswith(word))
    shipped = (
        semi(t.lineitem.filter(in_year("l_shipdate", date)), parts, {"l_partkey": "p_partkey"})
        .groupBy("l_partkey", "l_suppkey")
        .agg((F.lit(0.5) * F.sum("l_quantity")).alias("half"))
    )
    plenty = semi(t.partsupp, parts, {"ps_partkey": "p_partkey"}).join(
        shipped,
        _eq("ps_partkey", "l_partkey")
        & _eq("ps_suppkey", "l_suppkey")
        & (F.col("ps_availqty") > F.col("half")),
    )
    return (
        semi(_suppliers(t, nations=[nation]), plenty, {"s_suppkey": "ps_suppkey"})
        .select("s_name")
        .orderBy("s_name")
    )


def q21(t: Tables, nation: str = "NATION_20", limit: int = 100) -> DataFrame:
    """Suppliers who alone kept a multi-supplier order waiting.

    Two aggregations replace the self joins: late lines per (order, supplier), then per order the
    number of suppliers and of late ones. Where exactly one is late, it is the maximum of the
    late suppliers' keys.
    """
    late = F.when(F.col("l_receiptdate") > F.col("l_commitdate"), 1).otherwise(0)
    per_supplier = t.lineitem_x.groupBy("l_orderkey", "l_suppkey").agg(F.sum(late).alias("late"))
    is_late = F.col("late") > 0
    waiting = (
        per_supplier.groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("suppliers"),
            F.count_if(is_late).alias("late_suppliers"),
            F.max(F.when(is_late, F.col("l_suppkey"))).alias("culprit"),
            F.sum("late").alias("lines"),
        )
        .filter((F.col("suppliers") > 1) & (F.col("late_suppliers") == 1))
    )
    return (
        waiting.join(
            t.orders.filter(F.col("o_orderstatus") == "F"), _eq("l_orderkey", "o_orderkey"), "left_semi"
        )
        .groupBy("culprit")
        .agg(F.sum("lines").alias("lines"))
        .join(_suppliers(t, nations=[nation]), _eq("culprit", "s_suppkey"))
        .groupBy("s_name")
        .agg(F.sum("lines").alias("numwait"))
        .orderBy(F.desc("numwait"), "s_name")
        .limit(limit)
    )


def q22(
    t: Tables, codes: Sequence[str] = ("13", "31", "23", "29", "30", "18", "17"),
) -> DataFrame:
    """Customers of some phone codes with an above-average balance and no order at all."""
    customers = t.customer_x.select(
        "c_custkey", F.substring("c_phone", 1, 2).alias("cntrycode"), money("c_acctbal").alias("bal")
    ).filter(F.col("cntrycode").isin(list(codes)))
    average = customers.filter(F.col("bal") > 0).agg(mean(F.col("bal")).alias("average")).scalar()
    return (
        anti(customers.filter(F.col("bal").cast("double") > average), t.orders_x, {"c_custkey": "o_buyerkey"})
        .groupBy("cntrycode")
        .agg(F.count(F.lit(1)).alias("numcust"), F.sum("bal").alias("totacctbal"))
        .orderBy("cntrycode")
    )
