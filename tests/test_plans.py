"""Physical plans: pushed filters, pruned columns, join strategies, partial aggregation."""

import re

import pytest
from pyspark.sql import functions as F

from sparrowmill.catalog import joins as published
from sparrowmill.operators import scd2, windows
from sparrowmill.operators.plan_report import counts, kind, plan_steps
from sparrowmill.plans import models, tpch
from sparrowmill.registry import all_queries
from sparrowmill.sources.tables import Tables

QUERIES = all_queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "strategy, operator",
    [
        ("broadcast", "BroadcastHashJoin"),
        ("merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
        ("shuffle_replicate_nl", "CartesianProduct"),
    ],
)
def test_strategy_gives_its_operator(tables, strategy, operator):
    assert operator in plan(published.strategy_join(tables, strategy))


def test_large_sides_are_neither_broadcast_nor_looped(spark, tables, monkeypatch):
    from sparrowmill.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_LIMIT", 1)
    on = F.col("l_orderkey") == F.col("o_orderkey")
    for strategy in ("shuffle_replicate_nl", "broadcast"):
        with pytest.raises(ValueError, match=strategy):
            joins.join_with_strategy(tables.lineitem, tables.orders, on, strategy=strategy)


def test_nothing_is_multiplied_out(spark, tiny):
    """No nested loops or cross products, but in the two queries that show those operators."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("join_non_equi", "self_join_same_week", "tpch_q11", "tpch_q15", "tpch_q22", "tpch_q19",
                     "tpch_q21", "having_above_mean", "win_rank_trio", "dml_merge", "scd2_from_log"):
            text = plan(QUERIES[name](spark, tiny))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(tpch.q06(tables))
    (scan,) = [s for s in plan_steps(tpch.q06(tables), run=False) if kind(s.operator) == "scan"]
    assert "GreaterThanOrEqual(l_shipdate" in scan.pushed and "LessThan(l_quantity,24.0)" in scan.pushed
    assert scan.table == "lineitem" and scan.columns == 4
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"l_quantity", "l_extendedprice", "l_discount", "l_shipdate"}


def test_lazy_layers_prune_down_to_the_scan(spark, small):
    text = plan(QUERIES["daily_order_metrics"](spark, small))
    assert "c_name" not in text and "o_orderpriority" not in text


def test_filter_moves_below_the_aggregate(spark, small):
    text = plan(QUERIES["filter_after_agg"](spark, small))
    assert "Not(EqualTo(l_linestatus,O))" in text


def test_groups_combine_before_the_shuffle(spark, small):
    text = plan(QUERIES["qty_by_supplier"](spark, small))
    assert text.index("functions=[sum(") < text.index("Exchange hashpartitioning") < text.index("partial_sum")


def test_scan_and_project_need_no_shuffle(spark, small):
    assert "Exchange" not in plan(QUERIES["line_total"](spark, small))


def test_dedupe_limits_groups_before_the_shuffle(spark, small):
    text = plan(QUERIES["dedupe_row_number"](spark, small))
    assert text.count("WindowGroupLimit") == 2


def test_top_k_is_not_a_full_sort(spark, small):
    text = plan(QUERIES["topk_orders"](spark, small))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_pivot_values_save_the_distinct_scan(spark, small):
    assert counted(QUERIES["pivot_priority"](spark, small), "scan") == {"scan": 1}


def test_a_suite_is_one_pass(spark, small):
    from sparrowmill.operators.quality import Expectation, evaluate

    suite = [Expectation("not_null", "o_orderkey"), Expectation("between", "o_totalprice", {"max_value": 1})]
    orders = spark.read.parquet(f"{small}/orders.parquet")
    assert plan(evaluate(orders, suite)).count("FileScan") == 1
    # All uniqueness checks share another one.
    suite += [Expectation("unique", c) for c in ("o_orderkey", "o_custkey", "o_orderdate")]
    assert plan(evaluate(orders, suite)).count("FileScan") == 2


def test_ordinary_keys_take_the_plain_window(spark, small):
    for name in ("win_running_sum", "win_rank_trio", "win_prev2_sum", "scd2_from_log"):
        assert counted(QUERIES[name](spark, small)) == {"scan": 1, "exchange": 1}, name


def counted(df, *kinds):
    """Scans, exchanges and joins of the plan that ran."""
    found = counts(plan_steps(df))
    return {k: found[k] for k in kinds or ("scan", "exchange", "join") if k in found}


def test_a_hot_key_costs_one_sort_and_one_row_per_range(spark, small):
    """The table is read once to be sorted; what is left runs over the stored ranges."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.when(F.col("l_orderkey") % 3 == 0, 3).otherwise(F.col("l_orderkey")).alias("k"), "l_partkey", "l_discount"
    )
    order = [("l_discount", "desc")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = windows.ranked_and_running(
            lines, ["k"], order, rank="r", dense_rank="d", hot_rows=1000,
            row_number=("n", [*order, ("l_partkey", "asc")]),
        )
        steps = plan_steps(ranked)
        assert not [s for s in steps if s.table.startswith("lineitem")]
        found = counts(steps)
        # The range exchange (once more where it is not reused), the rows per range to one task, their broadcast.
        assert found["exchange"] <= 4 and found["join"] == 1
        assert not any("hashpartitioning(k" in line for line in plan(ranked).splitlines())
        moved = windows.moving(lines, ["k"], [*order, ("l_partkey", "asc")], (-1, 0), {"s": F.sum("l_partkey")}, hot_rows=1000)
        assert not [s for s in plan_steps(moved) if s.table.startswith("lineitem")]
        log = spark.read.parquet(f"{small}/events.parquet").select(
            F.when(F.col("user_id") % 3 == 0, 3).otherwise(F.col("user_id")).alias("id"), "event_type",
            (F.col("ts") + F.make_dt_interval(secs=F.col("event_id") * F.lit(0.000001))).alias("at"),
        )
        history = scd2.scd2_from_log(log, "id", ["event_type"], "at", hot_rows=1000)
        steps = plan_steps(history)
        assert not [s for s in steps if s.table.startswith("events")]
        assert "Window" in {s.operator for s in steps} and counts(steps)["exchange"] <= 6
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_brand_metrics_joins_the_stock_once(spark, small):
    steps = plan_steps(QUERIES["brand_metrics"](spark, small))
    found = counts(steps)
    assert found["scan"] <= 6 and found["exchange"] <= 12
    assert sum(s.table == "lineitem" for s in steps) == 2  # the lines and the stock made from them


def test_unique_checks_sort_nothing_twice(spark, small):
    for name in ("scd2_from_log", "dml_merge"):
        assert "SortAggregate" not in plan(QUERIES[name](spark, small)), name


def test_report_of_a_skewed_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    }
    rows = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.uuid().alias("text")
    )
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = rows.join(spark.range(0, 60_000, 2, 4).withColumnRenamed("id", "k"), "k")
        steps = plan_steps(joined)
        assert any(s.skewed for s in steps) and not any(s.skewed for s in plan_steps(rows))
        top = next(s for s in steps if s.operator == "SortMergeJoin")
        assert top.rows == joined.count()
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_no_python_in_any_plan(spark, tiny):
    for name in ("tpch_q01", "daily_category_metrics", "scd2_apply", "win_range_month", "one_big_table"):
        assert "Python" not in plan(QUERIES[name](spark, tiny)), name


def test_keys_of_an_aggregate_are_counted_in_other_tasks(spark, tiny):
    made = plan(QUERIES["pk_violations"](spark, tiny))
    # From one exchange to the next: three hash tables of one task's rows, were they not set apart.
    stages = re.split(r"Exchange", made[made.index("ps_partkey") :])
    assert made.count("REBALANCE_PARTITIONS") == 1
    assert max(len(re.findall(r"HashAggregate\(keys=\[[^\]]*_partkey", s)) for s in stages) <= 2


def test_one_big_table_moves_narrow_rows(spark, tiny):
    df = QUERIES["one_big_table"](spark, tiny)
    assert plan(df).count("REBALANCE_PARTITIONS") == 1
    # Derived columns are computed above the joins and cross no exchange.
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    joined = node.output().mkString(" ")
    assert "o_orderpriority" in joined and "l_shipdate" in joined
    assert not re.search("l_commitdate|l_shipmode|o_clerk|clerk|c_phone|p_container|s_comment|availqty", joined)


def test_one_big_table_where_rows_are_missing(spark, tiny):
    t = Tables(spark, tiny)
    t.orders = t.orders.where("o_orderkey % 3 > 0")
    t.customer = t.customer.where("c_custkey % 2 > 0")
    t.part = t.part.where("p_partkey % 4 > 0")
    t.supplier = t.supplier.where("s_suppkey % 3 > 0")
    gone = F.when(F.col("l_linenumber") > 1, F.col("l_partkey"))
    t.lineitem = t.lineitem.union(t.lineitem.limit(20)).withColumn("l_partkey", gone)
    t.partsupp = t.partsupp.where("ps_suppkey % 5 > 0")
    wide = models.one_big_table(t)
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_commitdate", "l_shipmode", "orderkey",
             "shippriority", "ordercomment", "clerk", "customerkey", "customerphone", "availqty", "supplycost",
             "partkey", "container", "manufacturer", "suppkey", "suppliercomment"]
    plain = (
        t.lineitem_x.join(t.orders_x, F.expr("l_orderkey = o_orderkey"), "left")
        .join(t.customer_x, F.expr("o_custkey = c_custkey"), "left")
        .join(t.partsupp, F.expr("l_partkey = ps_partkey AND l_suppkey = ps_suppkey"), "left")
        .join(t.part_x, F.expr("ps_partkey = p_partkey"), "left")
        .join(t.supplier_x, F.expr("ps_suppkey = s_suppkey"), "left")
        .select(*names[:6], "o_orderkey", "o_shippriority", "o_comment", "o_clerk", "c_custkey", "c_phone",
                "ps_availqty", "ps_supplycost", "p_partkey", "p_container", "p_mfgr", "s_suppkey", "s_comment")
    )
    assert sorted(map(str, wide.select(*names).collect())) == sorted(
        map(str, plain.toDF(*names).collect())
    )


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def exchanges(node):
    """The columns of every shuffle in a plan that has not run yet."""
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.executedPlan()
    found = [node.output().mkString(" ")] if node.getClass().getSimpleName() == "ShuffleExchangeExec" else []
    children = node.children()
    return found + [e for i in range(children.size()) for e in exchanges(children.apply(i))]


def test_one_big_table_moves_the_lines_twice(spark, small, no_broadcast):
    made = exchanges(QUERIES["one_big_table"](spark, small)._jdf.queryExecution().executedPlan())
    assert sum("l_shipdate" in e for e in made) == 2
    # The stock's keys move for their aggregate and once more; suppliers and their columns never do.
    assert sum("ps_partkey" in e for e in made) == 2 and not any("s_name" in e for e in made)


@pytest.mark.parametrize("few_bytes", [0, models.FEW_BYTES], ids=["many suppliers", "few suppliers"])
@pytest.mark.parametrize("many_rows", [5, models.MANY_ROWS], ids=["large parts", "small parts"])
def test_one_big_table_on_odd_rows(spark, no_broadcast, few_bytes, many_rows):
    t = Tables(spark, "/nowhere")
    day = "timestamp'1996-01-02 00:00:00'"
    # Parts 0 and null are bought often, by lines of which some come twice; keys miss on either side.
    t.lineitem = spark.range(120).selectExpr(
        "nullif(id % 23, 7) AS l_orderkey",
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 2 THEN id % 17 END AS l_partkey",
        "nullif(id % 11, 4) AS l_suppkey", "cast(id % 5 AS int) AS l_linenumber", "double(id % 9) AS l_quantity",
        "id / 8 AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'N' AS l_returnflag",
        "'O' AS l_linestatus", f"{day} AS l_shipdate",
    )
    t.lineitem = t.lineitem.union(t.lineitem.limit(30))
    t.orders = spark.range(20).selectExpr(
        "id AS o_orderkey", "nullif(id % 6, 2) AS o_custkey", "'F' AS o_orderstatus", "id / 4 AS o_totalprice",
        f"{day} AS o_orderdate", "'5-LOW' AS o_orderpriority",
    )
    t.customer = spark.range(5).selectExpr(
        "id AS c_custkey", "concat('c', id) AS c_name", "int(id) AS c_nationkey", "id / 2 AS c_acctbal",
        "'FURNITURE' AS c_mktsegment",
    )
    # Parts and suppliers come twice here and there, or have no key.
    t.part = spark.range(18).selectExpr(
        "CASE WHEN id < 15 THEN id WHEN id = 15 THEN 0 WHEN id = 16 THEN 5 END AS p_partkey",
        "concat('p', id) AS p_name", "'Brand#1' AS p_brand", "'SMALL' AS p_type", "int(id) AS p_size",
        "id / 2 AS p_retailprice",
    )
    t.supplier = spark.range(11).selectExpr(
        "CASE WHEN id < 9 THEN id WHEN id = 9 THEN 3 END AS s_suppkey", "concat('s', id) AS s_name",
        "int(id) AS s_nationkey", "id / 2 AS s_acctbal",
    )
    t.partsupp = t.partsupp.where("ps_suppkey IS NULL OR ps_suppkey % 5 > 0")
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "orderkey", "customername", "availqty",
             "partkey", "partname", "container", "suppkey", "suppliername", "suppliercomment"]
    plain = (
        t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey"), "left")
        .join(t.customer, F.expr("o_custkey = c_custkey"), "left")
        .join(t.partsupp, F.expr("l_partkey = ps_partkey AND l_suppkey = ps_suppkey"), "left")
        .join(t.part_x, F.expr("ps_partkey = p_partkey"), "left")
        .join(t.supplier_x, F.expr("ps_suppkey = s_suppkey"), "left")
        .select(*names[:4], "o_orderkey", "c_name", "ps_availqty", "p_partkey", "p_name", "p_container",
                "s_suppkey", "s_name", "s_comment")
    )
    wide = models.one_big_table(t, few_bytes, many_rows).select(*names)
    assert sorted(map(str, wide.collect())) == sorted(map(str, plain.toDF(*names).collect()))
