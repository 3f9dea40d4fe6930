"""The benchmark queries T01 to T22 and their variants."""

from sparrowmill.catalog.sql import CHARGE, DISC, PRICE, big, dbl, iso, with_ctes
from sparrowmill.plans import tpch
from sparrowmill.registry import query

query("tpch_q01", "T01 A16", f"""
    SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty,
      {dbl(f'SUM({PRICE})')} AS sum_base_price, {dbl(f'SUM({DISC})')} AS sum_disc_price,
      {dbl(f'SUM({CHARGE})')} AS sum_charge, AVG(l_quantity) AS avg_qty,
      {dbl(f'SUM({PRICE})')} / COUNT(l_extendedprice) AS avg_price,
      {dbl('SUM(CAST(l_discount AS DECIMAL(4,2)))')} / COUNT(l_discount) AS avg_disc,
      COUNT(*) AS count_order
    FROM lineitem WHERE l_shipdate <= DATE '2001-12-01' - INTERVAL 90 DAY
    GROUP BY l_returnflag, l_linestatus""")(tpch.q01)

query("tpch_q02", "T02 O02 A13", with_ctes("partsupp part_x supplier_x", f"""
    SELECT s_acctbal, s_name, n_name, p_partkey, p_mfgr, s_comment
    FROM part_x, supplier_x, partsupp, nation, region
    WHERE p_partkey = ps_partkey AND s_suppkey = ps_suppkey AND p_size = 15
      AND p_type LIKE '%MEDIUM' AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
      AND r_name = 'EUROPE' AND ps_supplycost = (
        SELECT MIN(ps_supplycost) FROM partsupp, supplier, nation, region
        WHERE p_partkey = ps_partkey AND s_suppkey = ps_suppkey AND s_nationkey = n_nationkey
          AND n_regionkey = r_regionkey AND r_name = 'EUROPE')
    ORDER BY s_acctbal DESC, n_name, s_name, p_partkey LIMIT 100"""))(tpch.q02)

query("tpch_q03", "T03 O02", with_ctes("orders_x", f"""
    SELECT l_orderkey, {dbl(f'SUM({DISC})')} AS revenue, {iso('o_orderdate')} AS o_orderdate,
      o_shippriority
    FROM customer, orders_x, lineitem
    WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey AND l_orderkey = o_orderkey
      AND o_orderdate < DATE '1995-03-15' AND l_shipdate > DATE '1995-03-15'
    GROUP BY l_orderkey, orders_x.o_orderdate, o_shippriority
    ORDER BY SUM({DISC}) DESC, orders_x.o_orderdate, l_orderkey LIMIT 10"""))(tpch.q03)

query("tpch_q04", "T04 J13", with_ctes("lineitem_x", """
    SELECT o_orderpriority, COUNT(*) AS order_count FROM orders
    WHERE o_orderdate >= DATE '1996-07-01' AND o_orderdate < DATE '1996-10-01'
      AND EXISTS (SELECT * FROM lineitem_x
                  WHERE l_orderkey = o_orderkey AND l_commitdate < l_receiptdate)
    GROUP BY o_orderpriority"""))(tpch.q04)

query("tpch_q05", "T05 J09", f"""
    SELECT n_name, {dbl(f'SUM({DISC})')} AS revenue
    FROM customer, orders, lineitem, supplier, nation, region
    WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey
      AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
      AND r_name = 'ASIA' AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'
    GROUP BY n_name""")(tpch.q05)

query("tpch_q06", "T06", f"""
    SELECT {dbl(f'SUM({PRICE} * CAST(l_discount AS DECIMAL(4,2)))')} AS revenue FROM lineitem
    WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01'
      AND l_discount BETWEEN 0.045 AND 0.075 AND l_quantity < 24""")(tpch.q06)

query("tpch_q07", "T07", f"""
    SELECT supp_nation, cust_nation, l_year, {dbl('SUM(volume)')} AS revenue FROM (
      SELECT n1.n_name AS supp_nation, n2.n_name AS cust_nation, CAST(year(l_shipdate) AS INTEGER) AS l_year,
        {DISC} AS volume
      FROM supplier, lineitem, orders, customer, nation n1, nation n2
      WHERE s_suppkey = l_suppkey AND o_orderkey = l_orderkey AND c_custkey = o_custkey
        AND s_nationkey = n1.n_nationkey AND c_nationkey = n2.n_nationkey
        AND ((n1.n_name = 'NATION_6' AND n2.n_name = 'NATION_7')
          OR (n1.n_name = 'NATION_7' AND n2.n_name = 'NATION_6'))
        AND l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '1997-01-01')
    GROUP BY supp_nation, cust_nation, l_year""")(tpch.q07)

_Q08 = f"""
    SELECT o_year, {dbl("SUM(CASE WHEN nation = 'NATION_7' THEN volume ELSE 0 END)")}
      / {dbl('SUM(volume)')} AS mkt_share FROM (
      SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, {DISC} AS volume, n2.n_name AS nation
      FROM part, supplier, lineitem, orders, customer, nation n1, nation n2, region
      WHERE p_partkey = l_partkey AND s_suppkey = l_suppkey AND l_orderkey = o_orderkey
        AND o_custkey = c_custkey AND c_nationkey = n1.n_nationkey
        AND n1.n_regionkey = r_regionkey AND r_name = 'ASIA' AND s_nationkey = n2.n_nationkey
        AND o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1997-01-01'
        AND p_type = 'ECONOMY')
    GROUP BY o_year"""
query("tpch_q08", "T08 A17 P19", _Q08)(tpch.q08)
query("tpch_q08_decode", "T08 P20 F07", _Q08)(lambda t: tpch.q08(t, use_decode=True))

query("tpch_q09", "T09 J10", with_ctes("partsupp", f"""
    SELECT nation, o_year, {dbl('SUM(amount)')} AS sum_profit FROM (
      SELECT n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS o_year,
        {DISC} - ps_supplycost * CAST(l_quantity AS DECIMAL(4,0)) AS amount
      FROM part, supplier, lineitem, partsupp, orders, nation
      WHERE s_suppkey = l_suppkey AND ps_suppkey = l_suppkey AND ps_partkey = l_partkey
        AND p_partkey = l_partkey AND o_orderkey = l_orderkey AND s_nationkey = n_nationkey
        AND p_name LIKE '%hot%')
    GROUP BY nation, o_year"""))(tpch.q09)

query("tpch_q10", "T10 O02", with_ctes("customer_x", f"""
    SELECT c_custkey, c_name, {dbl(f'SUM({DISC})')} AS revenue, c_acctbal, n_name, c_phone
    FROM customer_x, orders, lineitem, nation
    WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND o_orderdate >= DATE '1996-10-01'
      AND o_orderdate < DATE '1997-01-01' AND l_returnflag = 'R' AND c_nationkey = n_nationkey
    GROUP BY c_custkey, c_name, c_acctbal, n_name, c_phone
    ORDER BY SUM({DISC}) DESC, c_custkey LIMIT 20"""))(tpch.q10)

query("tpch_q11", "T11 A12 A13", with_ctes("partsupp", f"""
    SELECT ps_partkey, {dbl('SUM(ps_supplycost * ps_availqty)')} AS value
    FROM partsupp, supplier, nation
    WHERE ps_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_name = 'NATION_7'
    GROUP BY ps_partkey HAVING SUM(ps_supplycost * ps_availqty) > (
      SELECT SUM(ps_supplycost * ps_availqty) * CAST(0.0001 AS DECIMAL(5,4))
      FROM partsupp, supplier, nation
      WHERE ps_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_name = 'NATION_7')"""))(
    tpch.q11
)

_Q12 = with_ctes("lineitem_x", f"""
    SELECT l_shipmode,
      {big("SUM(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)")}
        AS high_line_count,
      {big("SUM(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)")}
        AS low_line_count
    FROM orders, lineitem_x
    WHERE o_orderkey = l_orderkey AND l_shipmode IN ('MAIL', 'SHIP')
      AND l_commitdate < l_receiptdate AND CAST(l_shipdate AS DATE) < l_commitdate
      AND l_receiptdate >= DATE '1996-01-01' AND l_receiptdate < DATE '1997-01-01'
    GROUP BY l_shipmode""")
query("tpch_q12", "T12 P19", _Q12)(tpch.q12)
query("tpch_q12_decode", "T12 P20 F07", _Q12)(lambda t: tpch.q12(t, use_decode=True))

query("tpch_q13", "T13 A19 F08", with_ctes("orders_x", """
    SELECT c_count, COUNT(*) AS custdist FROM (
      SELECT c_custkey, COUNT(o_orderkey) AS c_count
      FROM customer LEFT JOIN orders_x ON c_custkey = o_custkey
        AND o_comment NOT LIKE '%special%requests%'
      GROUP BY c_custkey)
    GROUP BY c_count"""))(tpch.q13)

_Q14 = f"""
    SELECT 100.0 * {dbl(f"SUM(CASE WHEN p_type LIKE 'PROMO%' THEN {DISC} ELSE 0 END)")}
      / {dbl(f'SUM({DISC})')} AS promo_revenue
    FROM lineitem, part
    WHERE l_partkey = p_partkey AND l_shipdate >= DATE '1995-09-01'
      AND l_shipdate < DATE '1995-10-01'"""
query("tpch_q14", "T14 A17 P19", _Q14)(tpch.q14)
query("tpch_q14_decode", "T14 P20 F07", _Q14)(lambda t: tpch.q14(t, use_decode=True))

query("tpch_q15", "T15 A13 V04", f"""
    WITH revenue AS (
      SELECT l_suppkey, SUM({DISC}) AS total_revenue FROM lineitem
      WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-04-01'
      GROUP BY l_suppkey)
    SELECT s_suppkey, s_name, {dbl('total_revenue')} AS total_revenue
    FROM supplier, revenue
    WHERE s_suppkey = l_suppkey
      AND revenue.total_revenue = (SELECT MAX(total_revenue) FROM revenue)""")(tpch.q15)

query("tpch_q16", "T16 J16 A11", with_ctes("partsupp supplier_x", """
    SELECT p_brand, p_type, p_size, COUNT(DISTINCT ps_suppkey) AS supplier_cnt
    FROM partsupp, part
    WHERE p_partkey = ps_partkey AND p_brand <> 'Brand#5' AND p_type NOT LIKE 'MEDIUM%'
      AND p_size IN (49, 14, 23, 45, 19, 3, 36, 9)
      AND ps_suppkey NOT IN (SELECT s_suppkey FROM supplier_x
                             WHERE s_comment LIKE '%Customer%Complaints%')
    GROUP BY p_brand, p_type, p_size"""))(tpch.q16)

query("tpch_q17", "T17 A13 A17 V06", with_ctes("part_x", f"""
    SELECT {dbl(f'SUM({PRICE})')} / 7.0 AS avg_yearly FROM lineitem, part_x
    WHERE p_partkey = l_partkey AND p_brand = 'Brand#23' AND p_container = 'MED BOX'
      AND l_quantity < (SELECT 0.2 * AVG(l_quantity) FROM lineitem
                        WHERE l_partkey = p_partkey)"""))(tpch.q17)

query("tpch_q18", "T18 A12 J15", f"""
    SELECT c_name, c_custkey, o_orderkey, {iso('o_orderdate')} AS o_orderdate, o_totalprice,
      SUM(l_quantity) AS sum_qty
    FROM customer, orders, lineitem
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey
                         HAVING SUM(l_quantity) > 300)
      AND c_custkey = o_custkey AND o_orderkey = l_orderkey
    GROUP BY c_name, c_custkey, o_orderkey, orders.o_orderdate, o_totalprice
    ORDER BY o_totalprice DESC, orders.o_orderdate, o_orderkey LIMIT 100""")(tpch.q18)

query("tpch_q19", "T19", with_ctes("lineitem_x part_x", f"""
    SELECT {dbl(f'SUM({DISC})')} AS revenue FROM lineitem_x, part_x
    WHERE p_partkey = l_partkey AND l_shipmode IN ('AIR', 'AIR REG')
      AND l_shipinstruct = 'DELIVER IN PERSON' AND (
        (p_brand = 'Brand#12' AND p_container IN ('SM CASE', 'SM BOX', 'SM PACK', 'SM PKG')
          AND l_quantity BETWEEN 1 AND 31 AND p_size BETWEEN 1 AND 5)
        OR (p_brand = 'Brand#23' AND p_container IN ('MED BAG', 'MED BOX', 'MED PKG', 'MED PACK')
          AND l_quantity BETWEEN 10 AND 40 AND p_size BETWEEN 1 AND 10)
        OR (p_brand = 'Brand#4' AND p_container IN ('LG CASE', 'LG BOX', 'LG PACK', 'LG PKG')
          AND l_quantity BETWEEN 20 AND 50 AND p_size BETWEEN 1 AND 15))"""))(tpch.q19)

query("tpch_q20", "T20 J15 V06", with_ctes("partsupp", """
    SELECT s_name FROM supplier, nation
    WHERE s_suppkey IN (
        SELECT ps_suppkey FROM partsupp
        WHERE ps_partkey IN (SELECT p_partkey FROM part WHERE p_name LIKE 'hot%')
          AND ps_availqty > (SELECT 0.5 * SUM(l_quantity) FROM lineitem
            WHERE l_partkey = ps_partkey AND l_suppkey = ps_suppkey
              AND l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01'))
      AND s_nationkey = n_nationkey AND n_name = 'NATION_3'"""))(tpch.q20)

query("tpch_q21", "T21 J13 J14 V06", with_ctes("lineitem_x", f"""
    SELECT s_name, COUNT(*) AS numwait
    FROM supplier, lineitem_x l1, orders, nation
    WHERE s_suppkey = l1.l_suppkey AND o_orderkey = l1.l_orderkey AND o_orderstatus = 'F'
      AND l1.l_receiptdate > l1.l_commitdate
      AND EXISTS (SELECT * FROM lineitem_x l2
        WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
      AND NOT EXISTS (SELECT * FROM lineitem_x l3
        WHERE l3.l_orderkey = l1.l_orderkey AND l3.l_suppkey <> l1.l_suppkey
          AND l3.l_receiptdate > l3.l_commitdate)
      AND s_nationkey = n_nationkey AND n_name = 'NATION_20'
    GROUP BY s_name ORDER BY numwait DESC, s_name LIMIT 100"""))(tpch.q21)

_CODES = "('13', '31', '23', '29', '30', '18', '17')"
query("tpch_q22", "T22 J14 F04 A13", with_ctes("customer_x orders_x", f"""
    SELECT cntrycode, COUNT(*) AS numcust, {dbl('SUM(bal)')} AS totacctbal FROM (
      SELECT substring(c_phone, 1, 2) AS cntrycode, CAST(c_acctbal AS DECIMAL(12,2)) AS bal
      FROM customer_x
      WHERE substring(c_phone, 1, 2) IN {_CODES}
        AND c_acctbal > (
          SELECT {dbl('SUM(CAST(c_acctbal AS DECIMAL(12,2)))')} / COUNT(*) FROM customer_x
          WHERE c_acctbal > 0 AND substring(c_phone, 1, 2) IN {_CODES})
        AND NOT EXISTS (SELECT * FROM orders_x
          WHERE o_buyerkey = c_custkey))
    GROUP BY cntrycode"""))(tpch.q22)
