"""Oracle SQL text shared by the published queries: derived tables as CTEs, and expressions."""

from __future__ import annotations

FIXED_TS = "TIMESTAMP '2024-01-01 00:00:00'"
AUDIT = f"{FIXED_TS} AS created_ts, 0 AS last_updated_by, {FIXED_TS} AS last_updated_ts"
ORDER_ITEM_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'))"
)

# name -> (CTEs it needs, SQL)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "lineitem_x": ((), """
        SELECT *,
          CAST(l_shipdate AS DATE)
            + CAST((l_partkey * 7 + l_linenumber * 13) % 61 - 30 AS INTEGER) AS l_commitdate,
          CAST(l_shipdate AS DATE)
            + CAST((l_suppkey * 11 + l_orderkey) % 30 + 1 AS INTEGER) AS l_receiptdate,
          ['AIR','AIR REG','REG AIR','MAIL','SHIP','TRUCK','RAIL','FOB']
            [(l_orderkey + l_linenumber) % 8 + 1] AS l_shipmode,
          ['DELIVER IN PERSON','COLLECT COD','NONE','TAKE BACK RETURN']
            [(l_partkey + l_linenumber) % 4 + 1] AS l_shipinstruct
        FROM lineitem"""),
    "partsupp": ((), """
        SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey,
          CAST((l_partkey * 37 + l_suppkey * 101) % 9999 + 1 AS INTEGER) AS ps_availqty,
          CAST(((l_partkey * 53 + l_suppkey * 17) % 99900 + 100) * 0.01 AS DECIMAL(15,2))
            AS ps_supplycost
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"""),
    "customer_x": ((), """
        SELECT *, (c_nationkey + 10) || '-' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
          || '-' || lpad(CAST(c_custkey * 7 % 10000 AS VARCHAR), 4, '0') AS c_phone
        FROM customer"""),
    "orders_x": ((), """
        SELECT *, 0 AS o_shippriority,
          'Clerk#' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 9, '0') AS o_clerk,
          CASE WHEN o_orderkey % 50 = 0 THEN 'special packages requests'
               ELSE 'regular deposits' END AS o_comment,
          CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_buyerkey
        FROM orders"""),
    "part_x": ((), """
        SELECT *, ['SM','MED','LG','JUMBO','WRAP'][p_partkey % 5 + 1] || ' '
          || ['CASE','BOX','PACK','PKG'][p_partkey % 4 + 1] AS p_container,
          'Manufacturer#' || (p_partkey % 5 + 1) AS p_mfgr
        FROM part"""),
    "supplier_x": ((), """
        SELECT *, CASE WHEN s_suppkey % 20 = 7 THEN 'Customer slow Complaints'
          ELSE 'steady' END AS s_comment
        FROM supplier"""),
    # The thirteen operational tables.
    "e_user": ((), f"""
        SELECT c_custkey * 2 AS user_id, c_name AS username,
          lower(c_name) || '@example.com' AS email, c_acctbal > 0 AS is_active, {AUDIT}
        FROM customer
        UNION ALL
        SELECT s_suppkey * 2 + 1, s_name, lower(s_name) || '@example.com', s_acctbal > 0, {AUDIT}
        FROM supplier"""),
    "e_buyer": ((), f"""
        SELECT c_custkey AS buyer_id, c_custkey * 2 AS user_id,
          {FIXED_TS} AS first_time_purchased_timestamp, {AUDIT} FROM customer"""),
    "e_seller": ((), f"""
        SELECT s_suppkey AS seller_id, s_suppkey * 2 + 1 AS user_id,
          {FIXED_TS} AS first_time_sold_timestamp, {AUDIT} FROM supplier"""),
    "e_orders": ((), """
        SELECT o_orderkey AS order_id, o_custkey AS buyer_id, o_orderdate AS order_ts,
          CAST(o_totalprice AS DECIMAL(10,2)) AS total_price, o_orderdate AS created_ts
        FROM orders"""),
    "e_order_item": ((), f"""
        SELECT {ORDER_ITEM_ID} AS order_item_id, l_orderkey AS order_id,
          l_partkey AS product_id, l_suppkey AS seller_id,
          CAST(l_quantity AS INTEGER) AS quantity,
          CAST(l_extendedprice AS DECIMAL(10,2)) AS base_price,
          CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
            AS DECIMAL(10,2)) AS tax,
          l_shipdate AS created_ts
        FROM lineitem"""),
    "e_brand": ((), f"""
        SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_id,
          p_brand AS name, 'COUNTRY_' || (CAST(split_part(p_brand, '#', 2) AS INTEGER) % 5)
          AS country, {AUDIT} FROM part"""),
    "e_manufacturer": ((), f"""
        SELECT DISTINCT CAST(p_partkey % 5 + 1 AS INTEGER) AS manufacturer_id,
          'Manufacturer#' || (p_partkey % 5 + 1) AS name,
          'TYPE_' || ((p_partkey % 5 + 1) % 2) AS type, {AUDIT} FROM part"""),
    "e_product": ((), f"""
        SELECT p_partkey AS product_id, p_name AS name, p_type AS description,
          CAST(p_retailprice AS DECIMAL(10,2)) AS price,
          CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_id,
          CAST(p_partkey % 5 + 1 AS INTEGER) AS manufacturer_id, {AUDIT} FROM part"""),
    "part_category": ((), """
        SELECT p_partkey, p_type AS name FROM part
        UNION ALL
        SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'POCKET' ELSE 'COMPACT' END
        FROM part WHERE p_size <= 25"""),
    "category_id": ((), """
        SELECT * FROM (VALUES ('ECONOMY', 1), ('LARGE', 2), ('MEDIUM', 3), ('PROMO', 4),
          ('SMALL', 5), ('STANDARD', 6), ('POCKET', 7), ('COMPACT', 8)) AS v(name, category_id)"""),
    "e_category": (("part_category", "category_id"), f"""
        SELECT category_id, name, {AUDIT}
        FROM category_id WHERE name IN (SELECT name FROM part_category)"""),
    "e_product_category": (("part_category", "category_id"), f"""
        SELECT p_partkey AS product_id, category_id, {AUDIT}
        FROM part_category JOIN category_id USING (name)"""),
    "e_ratings": ((), f"""
        SELECT {ORDER_ITEM_ID} AS ratings_id, l_partkey AS product_id,
          CAST(CAST(l_quantity AS DECIMAL(4,1)) * 0.1 AS DECIMAL(3,2)) AS rating, {AUDIT}
        FROM lineitem"""),
    "e_seller_product": ((), """
        SELECT DISTINCT l_suppkey AS seller_id, l_partkey AS product_id FROM lineitem"""),
    "e_clickstream": ((), """
        SELECT event_id, user_id, event_type,
          CASE WHEN event_type IN ('view', 'click') THEN event_id END AS product_id,
          CASE WHEN event_type = 'purchase' THEN event_id END AS order_id,
          ts AS timestamp, ts AS created_ts
        FROM events"""),
    # Silver and gold.
    "dim_buyer": (("e_user", "e_buyer"), """
        SELECT u.user_id, username, email, is_active, u.created_ts AS appuser_created_ts,
          u.last_updated_by AS appuser_last_updated_by,
          u.last_updated_ts AS appuser_last_updated_ts, buyer_id, first_time_purchased_timestamp,
          b.created_ts AS buyer_created_ts, b.last_updated_by AS buyer_last_updated_by,
          b.last_updated_ts AS buyer_last_updated_ts
        FROM e_user u JOIN e_buyer b ON u.user_id = b.user_id"""),
    "dim_seller": (("e_user", "e_seller"), """
        SELECT u.user_id, username, email, is_active, u.created_ts AS appuser_created_ts,
          u.last_updated_by AS appuser_last_updated_by,
          u.last_updated_ts AS appuser_last_updated_ts, seller_id, first_time_sold_timestamp,
          s.created_ts AS seller_created_ts, s.last_updated_by AS seller_last_updated_by,
          s.last_updated_ts AS seller_last_updated_ts
        FROM e_user u JOIN e_seller s ON u.user_id = s.user_id"""),
    "dim_product": (("e_product", "e_brand", "e_manufacturer"), """
        SELECT product_id, p.name AS product_name, description, price, p.brand_id,
          p.manufacturer_id, b.name AS brand_name, b.country AS brand_country,
          m.name AS manufacturer_name, m.type AS manufacturer_type
        FROM e_product p LEFT JOIN e_brand b ON p.brand_id = b.brand_id
          LEFT JOIN e_manufacturer m ON p.manufacturer_id = m.manufacturer_id"""),
    "fact_order_items": (("e_order_item",), """
        SELECT *, base_price - tax AS actual_price FROM e_order_item"""),
    "fact_orders": (("e_orders",), """
        SELECT *, CAST(total_price AS DOUBLE) * CAST(0.014 AS DOUBLE) AS total_price_usd,
          total_price * 70 AS total_price_inr FROM e_orders"""),
    "wide_orders": (("fact_orders", "dim_seller"), """
        SELECT o.*, s.* FROM fact_orders o LEFT JOIN dim_seller s ON o.buyer_id = s.seller_id"""),
    "wide_order_items": (("fact_order_items", "dim_seller"), """
        SELECT f.*, s.is_active FROM fact_order_items f
          LEFT JOIN dim_seller s ON f.seller_id = s.seller_id"""),
    "daily_order_metrics": (("wide_orders",), """
        SELECT CAST(order_ts AS DATE) AS order_date, SUM(total_price) AS total_price_sum,
          CAST(SUM(total_price) AS DOUBLE) / COUNT(total_price) AS total_price_mean
        FROM wide_orders WHERE is_active GROUP BY 1"""),
    "item_categories": (("wide_order_items", "e_product_category", "e_category"), """
        SELECT w.*, c.category_id, c.name AS category_name
        FROM wide_order_items w JOIN e_product_category p ON w.product_id = p.product_id
          JOIN e_category c ON p.category_id = c.category_id"""),
    "daily_category_metrics": (("item_categories",), """
        SELECT CAST(created_ts AS DATE) AS order_date, category_id, category_name,
          CAST(SUM(actual_price) AS DOUBLE) / COUNT(actual_price) AS mean_actual_price,
          quantile_disc(actual_price, 0.5) AS median_actual_price
        FROM item_categories WHERE is_active GROUP BY ALL"""),
}


def with_ctes(names: str, body: str, **more: str) -> str:
    """``body`` behind a WITH clause of the named CTEs, those they need, and ``more`` of its own."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name in ordered:
            return
        needs, sql = _CTES[name]
        for need in needs:
            add(need)
        ordered[name] = sql

    for name in names.split():
        add(name)
    ordered.update(more)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in ordered.items()) + " " + body


def iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def iso_ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(12,2))"


# Line amounts, exact.
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
DISC = "(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))"
CHARGE = (
    "(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
    " * (1 + CAST(l_tax AS DECIMAL(4,2))))"
)
