"""Data quality, key checks and result comparison."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.catalog.history import _HISTORY, KEY, TRACKED, TS, change_log
from sparrowmill.catalog.layers import node
from sparrowmill.catalog.sql import CHARGE, dbl, money as sql_money, with_ctes
from sparrowmill.functions.exact import charged
from sparrowmill.operators import quality
from sparrowmill.operators.quality import Expectation
from sparrowmill.operators.compare import compare_results as compare
from sparrowmill.operators.scd2 import scd2_from_log
from sparrowmill.operators.skew import apart
from sparrowmill.plans.runner import SUITES
from sparrowmill.plans.user_history import HISTORY_SUITE
from sparrowmill.registry import query

_ROW = "SELECT '{}' AS dataset, '{}' AS expectation, '{}' AS \"column\", {} AS observed, {} AS unexpected, {} = 0 AS success FROM {}"


def _row(dataset, kind, column, observed, unexpected, source):
    return _ROW.format(dataset, kind, column, dbl(observed), unexpected, unexpected, source)


@query("quality_report", "Q01 Q02 Q03 Q04 Q05 Q06", with_ctes(
    "fact_orders daily_order_metrics",
    " UNION ALL ".join([
        _row("fact_orders", "unique", "order_id", "COUNT(DISTINCT order_id)",
             "COUNT(order_id) - COUNT(DISTINCT order_id)", "fact_orders"),
        _row("daily_order_metrics", "unique", "order_date", "COUNT(DISTINCT order_date)",
             "COUNT(order_date) - COUNT(DISTINCT order_date)", "daily_order_metrics"),
        _row("daily_order_metrics", "max_between", "total_price_mean", "MAX(total_price_mean)",
             "CAST(MAX(total_price_mean) >= 100000 OR MAX(total_price_mean) < 0 AS BIGINT)",
             "daily_order_metrics"),
        _row("history", "not_null", "id", "COUNT(id)", "COUNT(*) - COUNT(id)", "history"),
        _row("history", "not_null", "start_date", "COUNT(start_date)",
             "COUNT(*) - COUNT(start_date)", "history"),
        _row("history", "matches_strftime", "start_date", "COUNT(start_date)",
             "CAST(0 AS BIGINT)", "history"),
        _row("history", "matches_strftime", "end_date", "COUNT(end_date)",
             "CAST(0 AS BIGINT)", "history"),
        _row("history", "between", "age", "COUNT(age)", "COUNT(*) FILTER (age > 10)", "history"),
        _row("orders", "matches_strftime", "date_text", "COUNT(*)",
             "COUNT(*) FILTER (o_orderkey % 3 = 0)", "orders"),
    ]), **_HISTORY))
def quality_report(t):
    history = scd2_from_log(change_log(t), KEY, TRACKED, TS)
    history = history.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start_date", "end_date")}
    )
    # Every third date is text of another kind.
    text = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    dated = t.orders.select(text.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_text"))
    suites = [
        ("fact_orders", node(t, "fact_orders"), SUITES["fact_orders"]),
        ("daily_order_metrics", node(t, "daily_order_metrics"), SUITES["daily_order_metrics"]),
        ("history", history, HISTORY_SUITE),
        ("orders", dated, [Expectation("matches_strftime", "date_text", {"format": "%Y-%m-%d"})]),
    ]
    reports = [
        quality.evaluate(df, suite).select(
            F.lit(name).alias("dataset"), "expectation", "column", "observed", "unexpected", "success"
        )
        for name, df, suite in suites
    ]
    return reduce(DataFrame.unionByName, reports)


# Primary keys of the benchmark tables, and their references.
PRIMARY_KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "part": ("p_partkey",),
    "supplier": ("s_suppkey",),
    "partsupp": ("ps_partkey", "ps_suppkey"),
    "customer": ("c_custkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "orders": ("o_orderkey",),
}
FOREIGN_KEYS = (
    ("nation", ("n_regionkey",), "region", ("r_regionkey",)),
    ("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    ("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    ("partsupp", ("ps_suppkey",), "supplier", ("s_suppkey",)),
    ("partsupp", ("ps_partkey",), "part", ("p_partkey",)),
    ("orders", ("o_custkey",), "customer", ("c_custkey",)),
    ("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    ("lineitem", ("l_partkey", "l_suppkey"), "partsupp", ("ps_partkey", "ps_suppkey")),
    ("orders", ("o_orderkey",), "lineitem", ("l_orderkey",)),  # an order has lines
)


@query("pk_violations", "Q07", with_ctes("partsupp", " UNION ALL ".join(f"""
    SELECT '{n}' AS table_name, COUNT(*) AS repeated_keys, CAST(COALESCE(SUM(c), 0) AS BIGINT) AS copies
    FROM (SELECT COUNT(*) AS c FROM {n} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)"""
    for n, k in PRIMARY_KEYS.items())))
def pk_violations(t):
    # The stock table is an aggregate on its key: its hash table is not to stand beside the count's two.
    checked = {name: getattr(t, name) for name in PRIMARY_KEYS}
    checked["partsupp"] = apart(checked["partsupp"])
    reports = [
        quality.pk_violations(checked[name], keys).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("repeated_keys"),
            F.coalesce(F.sum("copies"), F.lit(0)).alias("copies"),
        )
        for name, keys in PRIMARY_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query("fk_violations", "Q08", with_ctes("partsupp", " UNION ALL ".join(f"""
    SELECT '{child}->{parent}' AS reference, COUNT(*) AS orphans FROM {child} c
    WHERE {' AND '.join(f'{k} IS NOT NULL' for k in ck)}
      AND NOT EXISTS (SELECT * FROM {parent} p
        WHERE {' AND '.join(f'c.{a} = p.{b}' for a, b in zip(ck, pk))})"""
    for child, ck, parent, pk in FOREIGN_KEYS)))
def fk_violations(t):
    reports = [
        quality.fk_violations(
            getattr(t, child), getattr(t, parent), child_keys, parent_keys
        ).agg(
            F.lit(f"{child}->{parent}").alias("reference"),
            F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphans"),
        )
        for child, child_keys, parent, parent_keys in FOREIGN_KEYS
    ]
    return reduce(DataFrame.unionByName, reports)


@query("compare_results", "Q09", f"""
    WITH rebuilt AS (SELECT l_orderkey AS order_id, CAST(round(SUM({CHARGE}), 2) AS DECIMAL(18,2))
      AS total FROM lineitem GROUP BY l_orderkey)
    SELECT COALESCE(order_id, o_orderkey) AS order_id,
      CASE WHEN order_id IS NULL OR o_orderkey IS NULL THEN '(row)' ELSE 'total' END AS "column"
    FROM rebuilt FULL JOIN orders ON order_id = o_orderkey
    WHERE order_id IS NULL OR o_orderkey IS NULL
      OR abs({dbl('total')} - {dbl(sql_money('o_totalprice'))}) > 100""")
def compare_results(t):
    """Rebuilt order totals against the stored ones, within the tolerance of a sum."""
    rebuilt = t.lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.round(F.sum(charged()), 2).cast("decimal(18,2)").alias("total")
    )
    stored = t.order_totals.select(F.col("o_orderkey").alias("order_id"), "total")
    return compare(rebuilt, stored, ["order_id"], {"total": "sum"}).select("order_id", "column")
