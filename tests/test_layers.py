"""The layered pipeline: literal rows through the nodes, the run, its snapshots and its gate."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparrowmill.catalog.layers import RUN_TS, upstream, upstream_in_tens
from sparrowmill.operators.quality import InvalidData
from sparrowmill.plans import gold, silver
from sparrowmill.plans.bronze import BRONZE, STAMP, bronze
from sparrowmill.plans.runner import NODES, Node, Pipeline
from sparrowmill.sources.entities import ENTITIES

AUDIT = "created_ts string, last_updated_by int, last_updated_ts string"


@pytest.mark.parametrize("name", list(BRONZE))
def test_bronze_publishes_its_columns_and_adds_the_stamp(name, spark, tables):
    spec = BRONZE[name]
    source = ENTITIES[spec.source](tables)
    got = bronze(spec, source, RUN_TS)
    assert got.columns == [*spec.columns, STAMP]
    assert set(spec.keys) <= set(spec.columns)
    assert got.count() == source.count()
    assert got.select(STAMP).distinct().first()[0] == dt.datetime(2024, 6, 1)


@pytest.mark.parametrize("name", list(BRONZE))
def test_stand_in_keys_are_unique(name, tables):
    spec = BRONZE[name]
    frame = ENTITIES[spec.source](tables)
    assert frame.count() == frame.select(*spec.keys).distinct().count()


def test_dim_buyer(spark):
    user = spark.createDataFrame([(1, "u", "u@x", True, "c1", 7, "t1")], f"user_id int, username string, email string, is_active boolean, {AUDIT}")
    buyer = spark.createDataFrame([(9, 1, "f", "c2", 8, "t2"), (10, 2, "f", "c2", 8, "t2")], f"buyer_id int, user_id int, first_time_purchased_timestamp string, {AUDIT}")
    got = silver.dim_buyer(user.withColumn(STAMP, F.lit("a")), buyer.withColumn(STAMP, F.lit("b")))
    assert [tuple(r) for r in got.collect()] == [(1, "u", "u@x", True, "c1", 7, "t1", 9, "f", "c2", 8, "t2")]


def test_dim_product_keeps_products_without_brand(spark):
    product = spark.createDataFrame([(1, "p", "d", 1, None), (2, "q", "d", None, 5)], "product_id int, name string, description string, brand_id int, manufacturer_id int").withColumn("price", F.lit("1.00").cast("decimal(10,2)"))
    brand = spark.createDataFrame([(1, "b", "DE")], "brand_id int, name string, country string")
    maker = spark.createDataFrame([(5, "m", "t")], "manufacturer_id int, name string, type string")
    got = {r.product_id: r for r in silver.dim_product(product, brand, maker).collect()}
    assert (got[1].product_name, got[1].brand_name, got[1].manufacturer_name) == ("p", "b", None)
    assert (got[2].brand_country, got[2].manufacturer_type) == (None, "t")


def test_fact_order_items_actual_price(spark):
    rows = [(1, 100, 500, 10, 2, Decimal("100.00"), Decimal("10.00"), "2024-01-01")]
    items = spark.createDataFrame(rows, "order_item_id int, order_id int, product_id int, seller_id int, quantity int, base_price decimal(10,2), tax decimal(10,2), created_ts string")
    assert silver.fact_order_items(items).first().actual_price == Decimal("90.00")


def test_order_metrics_count_active_parties_only(spark):
    rows = [(1, "2024-01-01 10:00:00", "10.00", True), (2, "2024-01-01 23:00:00", "20.00", True), (3, "2024-01-01 23:00:00", "40.00", False), (4, "2024-01-02 00:00:00", "80.00", None)]
    wide = spark.createDataFrame(rows, "order_id int, order_ts string, total_price string, is_active boolean").withColumns({"order_ts": F.col("order_ts").cast("timestamp"), "total_price": F.col("total_price").cast("decimal(10,2)")})
    assert [tuple(r) for r in gold.daily_order_metrics(wide).collect()] == [(dt.date(2024, 1, 1), Decimal("30.00"), 15.0)]


def test_category_metrics_drop_items_without_category(spark):
    kind = "array<struct<category_id int, category_name string>>"
    rows = [("2024-01-01", "1.00", True, [(1, "a"), (2, "b")]), ("2024-01-01", "3.00", True, [(1, "a")]), ("2024-01-01", "5.00", True, []), ("2024-01-01", "5.00", True, None), ("2024-01-01", "7.00", None, [(1, "a")])]
    wide = spark.createDataFrame(rows, f"created_ts string, actual_price string, is_active boolean, categories {kind}")
    wide = wide.withColumns({"created_ts": F.col("created_ts").cast("timestamp"), "actual_price": F.col("actual_price").cast("decimal(10,2)")})
    got = {r.category.category_name: (r.mean_actual_price, r.median_actual_price) for r in gold.daily_category_metrics(wide).collect()}
    assert got == {"a": (2.0, Decimal("1.00")), "b": (1.0, Decimal("1.00"))}


def test_each_node_once_and_upstream_first(spark, tables):
    order = Pipeline().order(["daily_category_metrics", "daily_order_metrics"])
    assert len(order) == len(set(order)) and len(order) == 19
    for node in NODES:
        if node.name in order:
            assert all(order.index(u) < order.index(node.name) for u in node.upstream)
    asked = []

    def sources(name):
        asked.append(name)
        return ENTITIES[name](tables)

    Pipeline().run(spark, ["daily_category_metrics", "daily_order_metrics"], sources, RUN_TS, validate=False)
    assert sorted(asked) == sorted(set(asked)) and "buyer" not in asked


def test_a_run_can_be_stored_and_read_again(spark, tables, tmp_path):
    path = str(tmp_path / "lake")
    pipeline, sources = Pipeline(), upstream_in_tens(tables)
    lazy = pipeline.run(spark, ["daily_order_metrics"], sources, RUN_TS, validate=False)
    first = pipeline.run(spark, ["daily_order_metrics"], sources, RUN_TS, path)
    second = pipeline.run(spark, ["daily_order_metrics"], sources, "2024-06-02 00:00:00", path)
    rows = lambda run: sorted(map(tuple, run["daily_order_metrics"].df.drop(STAMP).collect()))
    assert rows(first) == rows(second) == rows(lazy)
    assert {r[0].day for r in first["orders"].df.select(STAMP).distinct().collect()} == {1}
    assert first["daily_order_metrics"].path == f"{path}/daily_order_metrics"


def test_a_failing_suite_stops_the_run(spark, tables):
    with pytest.raises(InvalidData, match="daily_order_metrics.*max_between"):
        Pipeline().run(spark, ["daily_order_metrics"], upstream(tables), RUN_TS)


def test_rejected_rows_are_never_published(spark, tables, tmp_path):
    from sparrowmill.sources.snapshots import list_snapshots

    path = str(tmp_path / "lake")
    with pytest.raises(InvalidData):
        Pipeline().run(spark, ["daily_order_metrics"], upstream(tables), RUN_TS, path)
    assert list_snapshots(spark, f"{path}/wide_orders", STAMP) == [RUN_TS]
    assert list_snapshots(spark, f"{path}/daily_order_metrics", STAMP) == []
    for _ in range(2):
        done = Pipeline().run(spark, ["daily_order_metrics"], upstream_in_tens(tables), RUN_TS, path)
    assert list_snapshots(spark, f"{path}/daily_order_metrics", STAMP) == [RUN_TS]
    assert done["daily_order_metrics"].df.count() > 0


def test_repeated_orders_stop_the_run(spark, tables):
    def sources(name):
        frame = ENTITIES[name](tables)
        return frame.unionAll(frame.limit(1)) if name == "orders" else frame

    with pytest.raises(InvalidData, match="orders.*unique"):
        Pipeline().run(spark, ["fact_orders"], sources, RUN_TS)


def test_node_definitions_are_checked(spark, tables):
    with pytest.raises(ValueError, match="unknown nodes"):
        Pipeline([Node("a", ("k",), ("missing",), lambda df: df)])
    wrong = [n for n in NODES if n.name != "fact_orders"] + [Node("fact_orders", ("nope",), ("orders",), silver.fact_orders)]
    with pytest.raises(ValueError, match="key columns"):
        Pipeline(wrong).run(spark, ["fact_orders"], upstream(tables), RUN_TS, validate=False)


def test_reports_are_global_views(spark, tables):
    metrics = Pipeline().run(spark, ["daily_order_metrics"], upstream(tables), RUN_TS, validate=False)
    gold.daily_order_report(metrics["daily_order_metrics"].df)
    assert spark.sql("SELECT * FROM global_temp.daily_order_report").columns == ["Date", "Revenue", "Mean Revenue"]


def test_both_reports_from_one_run(spark, tables, tmp_path):
    from sparrowmill.plans.runner import run_reports

    views = run_reports(spark, upstream_in_tens(tables), RUN_TS, str(tmp_path / "lake"))
    assert views["daily_category_report"].columns == ["Date", "Product Category", "Mean Revenue", "Median Revenue"]
    assert views["daily_order_report"].count() > 0 and views["daily_category_report"].count() > 0


def test_user_history_runs(spark, tmp_path):
    from sparrowmill.plans.user_history import SNAPSHOT, run_user_history
    from sparrowmill.sources.snapshots import list_snapshots

    def users(*rows):
        frame = spark.createDataFrame(list(rows), "id int, name string, age int, updated_at string, extra int")
        return frame.withColumn("updated_at", F.col("updated_at").cast("timestamp"))

    path = str(tmp_path / "users")
    first = users((1, "a", 1, "2024-01-01 00:00:00", 0), (2, "b", 20, "2024-01-01 00:00:00", 0))
    second = users((1, "a", 2, "2024-01-05 00:00:00", 0), (2, "c", 20, "2023-12-31 00:00:00", 0))
    run_user_history(spark, first, path, "2024-01-02 00:00:00")
    for _ in range(2):  # the second time is a rerun
        done = run_user_history(spark, second, path, "2024-01-06 00:00:00")
    versions = sorted((r.id, r.age, r.is_active) for r in done["report"].collect())
    assert versions == [(1, 1, False), (1, 2, True), (2, 20, True)]
    assert [r.name for r in done["late"].collect()] == ["c"]
    assert [r.success for r in sorted(done["checks"].collect(), key=lambda r: r["position"])] == [True, True, True, True, False]
    assert list_snapshots(spark, path, SNAPSHOT) == ["2024-01-02 00:00:00", "2024-01-06 00:00:00"]
    assert spark.sql("SELECT * FROM global_temp.scd_users_report").columns == ["id", "is_active", "start_date", "end_date", "name", "age"]


def test_a_gate_watches_the_write(spark, tables, tmp_path):
    """The aggregates come from the job that writes; uniqueness reads its own columns only."""
    from sparrowmill.operators.quality import Expectation, Gate

    suite = [
        Expectation("unique", "o_orderkey"), Expectation("unique", "o_custkey"), Expectation("not_null", "o_orderdate"),
        Expectation("max_between", "o_totalprice", {"max_value": 10}),
    ]
    gate, path = Gate(suite, "orders"), str(tmp_path / "orders")
    gate.watch(tables.orders).write.parquet(path)
    assert set(gate.observed.get) == {"seen2", "bad2", "seen3", "bad3"} and gate.observed.get["bad3"] == 1
    with pytest.raises(InvalidData, match=r"unique\(o_custkey\): \d+ unexpected, max_between\(o_totalprice\): 1 "):
        gate.verdict(spark.read.parquet(path))
    Gate(suite[:1] + suite[2:3], "orders").enforce(tables.orders)
    with pytest.raises(InvalidData, match="max_between"):
        Gate(suite[3:], "orders").enforce(tables.orders)
