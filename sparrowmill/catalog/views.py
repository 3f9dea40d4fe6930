"""Subqueries, CTE-style plans, views and the wide model."""

from pyspark.sql import functions as F

from sparrowmill.catalog.sql import CHARGE, PRICE, dbl, iso, iso_ts, with_ctes
from sparrowmill.plans import models
from sparrowmill.registry import query

_NATIONS = """
    WITH supplied AS (
      SELECT s_nationkey AS k, SUM(l_quantity) AS q FROM lineitem
        JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
    purchased AS (
      SELECT c_nationkey AS k, SUM(l_quantity) AS q FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1)"""
_FROM_NATIONS = """FROM nation LEFT JOIN supplied s ON n_nationkey = s.k
      LEFT JOIN purchased p ON n_nationkey = p.k"""


@query("nation_supply_purchase", "V01 J12", f"""{_NATIONS}
    SELECT n_name AS nation_name, s.q AS supplied_items_quantity, p.q AS purchased_items_quantity
    {_FROM_NATIONS}""")
def nation_supply_purchase(t):
    return models.nation_quantities(t).select(
        "nation_name",
        F.col("supplied").alias("supplied_items_quantity"),
        F.col("purchased").alias("purchased_items_quantity"),
    )


@query("nation_sold_to_purchase", "V02 J12", f"""{_NATIONS}
    SELECT n_name AS nation_name, s.q AS num_supplied_parts, p.q AS num_purchased_parts,
      round(s.q / p.q * 100, 2) AS sold_to_purchase_perc {_FROM_NATIONS}""")
def nation_sold_to_purchase(t):
    return models.nation_quantities(t).select(
        "nation_name",
        F.col("supplied").alias("num_supplied_parts"),
        F.col("purchased").alias("num_purchased_parts"),
        F.round(F.col("supplied") / F.col("purchased") * 100, 2).alias("sold_to_purchase_perc"),
    )


# Every stocked line with its brand, its supplier and, where the order has one, its customer; from it
# what each of them spent per brand, and from that the brand's totals.
_BRANDS = f"""
    stocked AS (
      SELECT p_brand AS brand, l_suppkey AS supplier, c_custkey AS customer, {CHARGE} AS charge, {PRICE} AS price
      FROM lineitem JOIN part ON p_partkey = l_partkey
        LEFT JOIN (orders JOIN customer ON c_custkey = o_custkey) ON o_orderkey = l_orderkey
      WHERE EXISTS (SELECT * FROM partsupp WHERE ps_partkey = l_partkey AND ps_suppkey = l_suppkey)),
    spent AS (
      SELECT brand, 'supplier' AS side, supplier AS who, round(SUM(charge), 2) AS gross,
        round(SUM(price), 2) AS net FROM stocked GROUP BY brand, supplier
      UNION ALL
      SELECT brand, 'customer', customer, round(SUM(charge), 2), round(SUM(price), 2)
      FROM stocked WHERE customer IS NOT NULL GROUP BY brand, customer),
    totals AS (
      SELECT brand, COUNT(who) FILTER (side = 'customer') AS customers,
        COUNT(who) FILTER (side = 'supplier') AS suppliers,
        SUM(gross) FILTER (side = 'supplier') AS sold, SUM(net) FILTER (side = 'supplier') AS sold_net,
        SUM(gross) FILTER (side = 'customer') AS spend, SUM(net) FILTER (side = 'customer') AS spend_net
      FROM spent GROUP BY brand)"""


def _brand_sql(weight):
    base = with_ctes("partsupp", "@")
    return base.replace(" @", f", {_BRANDS}") + f"""
    SELECT brand, CAST(customers * {weight} AS BIGINT) AS num_customers,
      CAST(suppliers * {weight} AS BIGINT) AS num_suppliers,
      {dbl(f'sold * {weight}')} AS supplier_total_sold,
      {dbl(f'sold_net * {weight}')} AS supplier_total_sold_wo_tax_discounts,
      {dbl(f'spend * {weight}')} AS cust_total_spend,
      {dbl(f'spend_net * {weight}')} AS cust_total_spend_wo_tax_discounts
    FROM totals JOIN (SELECT p_brand, COUNT(*) AS parts FROM part GROUP BY p_brand) ON p_brand = brand
    WHERE customers > 0 AND suppliers > 0"""


@query("brand_metrics", "V03 J10 J12", _brand_sql("1"))
def brand_metrics(t):
    return models.brand_metrics(t)


@query("brand_metrics_fanout", "V03", _brand_sql("parts"))
def brand_metrics_fanout(t):
    return models.brand_metrics(t, fanout=True)


@query("view_nation_quantity", "V04", f"""{_NATIONS}
    SELECT n_name AS nation_name, s.q AS supplied, p.q AS purchased {_FROM_NATIONS}""")
def view_nation_quantity(t):
    models.nation_quantities(t).createOrReplaceTempView("nation_supplied_purchased_quantity")
    return t.spark.table("nation_supplied_purchased_quantity")


@query("one_big_table", "V07 J09 P17", with_ctes(
    "lineitem_x orders_x customer_x partsupp part_x supplier_x", f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
      l_tax, l_returnflag, l_linestatus,
      {iso_ts('l_shipdate')} AS l_shipdate,
      {iso('l_commitdate')} AS l_commitdate, {iso('l_receiptdate')} AS l_receiptdate,
      l_shipmode, l_shipinstruct, o_orderkey AS orderkey, o_custkey AS ordercustomerkey,
      o_orderstatus AS orderstatus, o_totalprice AS ordertotalprice,
      {iso_ts('o_orderdate')} AS orderdate, o_orderpriority AS orderpriority,
      o_clerk AS clerk, o_shippriority AS shippriority, o_comment AS ordercomment,
      c_custkey AS customerkey, c_name AS customername, c_nationkey AS customernationkey,
      c_phone AS customerphone, c_acctbal AS customeraccountbal,
      c_mktsegment AS customermktsegment, ps_availqty AS availqty,
      {dbl('ps_supplycost')} AS supplycost, p_partkey AS partkey, p_name AS partname,
      p_mfgr AS manufacturer, p_brand AS brand, p_type AS parttype, p_size AS partsize,
      p_container AS container, p_retailprice AS retailprice, s_suppkey AS suppkey,
      s_name AS suppliername, s_nationkey AS suppliernationkey, s_acctbal AS supplieracctbal,
      s_comment AS suppliercomment
    FROM lineitem_x LEFT JOIN orders_x ON l_orderkey = o_orderkey
      LEFT JOIN customer_x ON o_custkey = c_custkey
      LEFT JOIN partsupp ON l_partkey = ps_partkey AND l_suppkey = ps_suppkey
      LEFT JOIN part_x ON ps_partkey = p_partkey
      LEFT JOIN supplier_x ON ps_suppkey = s_suppkey"""))
def one_big_table(t):
    return models.one_big_table(t)
