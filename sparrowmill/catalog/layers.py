"""The layered pipeline: every bronze, silver and gold table, the reports and the whole run."""

from pyspark.sql import functions as F

from sparrowmill.catalog.sql import dbl, iso, iso_ts, with_ctes
from sparrowmill.plans import gold
from sparrowmill.plans.bronze import BRONZE, STAMP
from sparrowmill.plans.runner import Pipeline
from sparrowmill.registry import query
from sparrowmill.sources.entities import ENTITIES
from sparrowmill.sources.files import shared_folder

RUN_TS = "2024-06-01 00:00:00"


def upstream(t):
    """Upstream tables by name, as the pipeline asks for them."""
    return lambda source: ENTITIES[source](t)


def upstream_in_tens(t):
    """The same with order totals in tens. The stand-in orders cost up to 500,000, which the published
    suite (daily means below 100,000) rightly stops, as the pipeline tests show."""
    tens = F.round(F.col("total_price") * F.lit("0.1").cast("decimal(2,1)"), 2).cast("decimal(10,2)")

    def table(source):
        rows = ENTITIES[source](t)
        return rows.withColumn("total_price", tens) if source == "orders" else rows

    return table


def node(t, name, **options):
    """One node's published table, built lazily through all layers below it."""
    done = Pipeline().run(t.spark, [name], upstream(t), RUN_TS, validate=False)
    return done[name].df.drop(STAMP)


def _replace(cte, timestamps="", decimals="", extra=""):
    """SELECT * with timestamps as text and decimals as double."""
    parts = [f"{iso_ts(c)} AS {c}" for c in timestamps.split()]
    parts += [f"{dbl(c)} AS {c}" for c in decimals.split()]
    replaced = f" REPLACE ({', '.join(parts)})" if parts else ""
    return with_ctes(cte, f"SELECT *{extra}{replaced} FROM {cte}")


_AUDIT = "created_ts last_updated_ts"
_BRONZE_SQL = {
    "user": _replace("e_user", _AUDIT),
    "brand": _replace("e_brand", _AUDIT),
    "buyer": _replace("e_buyer", f"{_AUDIT} first_time_purchased_timestamp"),
    "category": _replace("e_category", _AUDIT),
    "clickstream": _replace("e_clickstream", "created_ts timestamp"),
    "manufacturer": _replace("e_manufacturer", _AUDIT),
    "order_item": _replace("e_order_item", "created_ts", "base_price tax"),
    "orders": _replace("e_orders", "order_ts created_ts", "total_price"),
    "product": _replace("e_product", _AUDIT, "price"),
    "product_category": _replace("e_product_category", _AUDIT),
    "ratings": _replace("e_ratings", _AUDIT, "rating"),
    "seller": _replace("e_seller", f"{_AUDIT} first_time_sold_timestamp"),
    "seller_product": _replace("e_seller_product"),
}
for _number, _name in enumerate(
    ("user", "brand", "buyer", "category", "clickstream", "manufacturer", "order_item", "orders",
     "product", "product_category", "ratings", "seller", "seller_product"), start=1
):
    query(f"bronze_{_name}", f"M{_number:02d} P21 S14", _BRONZE_SQL[_name])(
        lambda t, name=_name: node(t, name)
    )

_DIM_TS = "appuser_created_ts appuser_last_updated_ts"
_SELLER_TS = f"{_DIM_TS} first_time_sold_timestamp seller_created_ts seller_last_updated_ts"


@query("dim_buyer", "M14 P15 P16", _replace(
    "dim_buyer",
    f"{_DIM_TS} first_time_purchased_timestamp buyer_created_ts buyer_last_updated_ts"))
def dim_buyer(t):
    return node(t, "dim_buyer")


@query("dim_seller", "M15 P15", _replace("dim_seller", _SELLER_TS))
def dim_seller(t):
    return node(t, "dim_seller")


@query("dim_product", "M16 P17", _replace("dim_product", "", "price"))
def dim_product(t):
    return node(t, "dim_product")


@query("dim_category", "M17 P17", with_ctes("e_category", f"""
    SELECT category_id, name AS category_name, {iso_ts('created_ts')} AS created_ts,
      last_updated_by, {iso_ts('last_updated_ts')} AS last_updated_ts FROM e_category"""))
def dim_category(t):
    return node(t, "dim_category")


@query("fact_order_items", "M18 P12", _replace(
    "fact_order_items", "created_ts", "base_price tax actual_price"))
def fact_order_items(t):
    return node(t, "fact_order_items")


@query("fact_orders", "M19 P13", _replace(
    "fact_orders", "order_ts created_ts", "total_price total_price_inr"))
def fact_orders(t):
    return node(t, "fact_orders")


@query("product_x_category", "M20", _replace("e_product_category", _AUDIT))
def product_x_category(t):
    return node(t, "product_x_category")


@query("seller_x_product", "M21", _replace("e_seller_product"))
def seller_x_product(t):
    return node(t, "seller_x_product")


@query("wide_orders", "M22", _replace(
    "wide_orders", f"order_ts created_ts {_SELLER_TS}", "total_price total_price_inr"))
def wide_orders(t):
    return node(t, "wide_orders")


@query("wide_orders_buyer", "M22", with_ctes("fact_orders dim_buyer", f"""
    SELECT order_id, o.buyer_id, user_id, username, is_active, {dbl('total_price')} AS total_price
    FROM fact_orders o LEFT JOIN dim_buyer b ON o.buyer_id = b.buyer_id"""))
def wide_orders_buyer(t):
    orders = gold.wide_orders(
        node(t, "fact_orders"), node(t, "dim_buyer"), on=("buyer_id", "buyer_id")
    )
    return orders.select("order_id", "buyer_id", "user_id", "username", "is_active", "total_price")


def _category_text(column="categories"):
    labels = F.transform(
        column, lambda c: F.concat(c["category_id"].cast("string"), F.lit(":"), c["category_name"])
    )
    return F.array_join(labels, ",")


_CATEGORY_SQL = "string_agg(category_id || ':' || name, ',' ORDER BY category_id)"


@query("wide_order_items", "M23 J11 A15", with_ctes(
    "wide_order_items e_product_category e_category", f"""
    SELECT order_item_id, order_id, w.product_id, seller_id, quantity,
      {dbl('base_price')} AS base_price, {dbl('actual_price')} AS actual_price,
      {iso_ts('w.created_ts')} AS created_ts, {dbl('tax')} AS tax, categories, is_active
    FROM wide_order_items w LEFT JOIN (
      SELECT product_id, {_CATEGORY_SQL} AS categories
      FROM e_product_category JOIN e_category USING (category_id) GROUP BY product_id) c
      ON w.product_id = c.product_id"""))
def wide_order_items(t):
    return node(t, "wide_order_items").withColumn("categories", _category_text())


@query("category_arrays", "A15 F20", with_ctes("e_product_category e_category", f"""
    SELECT product_id, COUNT(*) AS n, {_CATEGORY_SQL} AS categories
    FROM e_product_category JOIN e_category USING (category_id) GROUP BY product_id"""))
def category_arrays(t):
    arrays = gold.product_categories(node(t, "product_x_category"), node(t, "dim_category"))
    return arrays.select(
        "product_id", F.size("categories").cast("bigint").alias("n"),
        _category_text().alias("categories"),
    )


@query("explode_categories", "F20", with_ctes("e_product_category e_category", """
    SELECT product_id, category_id, name AS category_name
    FROM e_product_category JOIN e_category USING (category_id)"""))
def explode_categories(t):
    arrays = gold.product_categories(node(t, "product_x_category"), node(t, "dim_category"))
    return arrays.select("product_id", F.explode("categories").alias("c")).select("product_id", "c.*")


_ORDER_METRICS = f"{iso('order_date')} AS order_date, {dbl('total_price_sum')} AS total_price_sum, total_price_mean"


@query("daily_order_metrics", "M24 A16 P18 S11", with_ctes(
    "daily_order_metrics", f"SELECT {_ORDER_METRICS} FROM daily_order_metrics"))
def daily_order_metrics(t):
    return node(t, "daily_order_metrics")


@query("daily_category_metrics", "M25 A14 F20", with_ctes("daily_category_metrics", f"""
    SELECT {iso('order_date')} AS order_date, category_id, category_name, mean_actual_price,
      {dbl('median_actual_price')} AS median_actual_price FROM daily_category_metrics"""))
def daily_category_metrics(t):
    return node(t, "daily_category_metrics").select(
        "order_date", "category.category_id", "category.category_name", "mean_actual_price",
        "median_actual_price",
    )


@query("report_daily_order", "M26 V05", with_ctes("daily_order_metrics", f"""
    SELECT {iso('order_date')} AS "Date", {dbl('total_price_sum')} AS "Revenue",
      total_price_mean AS "Mean Revenue" FROM daily_order_metrics"""))
def report_daily_order(t):
    return gold.daily_order_report(node(t, "daily_order_metrics"))


@query("report_daily_category", "M27 V05", with_ctes("daily_category_metrics", f"""
    SELECT {iso('order_date')} AS "Date", category_name AS "Product Category",
      mean_actual_price AS "Mean Revenue", {dbl('median_actual_price')} AS "Median Revenue"
    FROM daily_category_metrics"""))
def report_daily_category(t):
    report = gold.daily_category_report(node(t, "daily_category_metrics"))
    return report.withColumn("Product Category", F.col("`Product Category`.category_name"))


@query("medallion_run", "M28 S08 S09 S10 Q06", with_ctes("wide_orders", f"""
    SELECT {_ORDER_METRICS} FROM (
      SELECT order_date, SUM(price) AS total_price_sum,
        CAST(SUM(price) AS DOUBLE) / COUNT(price) AS total_price_mean
      FROM (SELECT CAST(order_ts AS DATE) AS order_date,
          CAST(round(total_price * CAST(0.1 AS DECIMAL(2,1)), 2) AS DECIMAL(10,2)) AS price
        FROM wide_orders WHERE is_active)
      GROUP BY 1)"""))
def medallion_run(t):
    """The order branch under the published suite, with every table written as a snapshot, checked and
    read back."""
    run = Pipeline().run(
        t.spark, ["daily_order_metrics"], upstream_in_tens(t), RUN_TS, path=shared_folder(t.spark)
    )
    return run["daily_order_metrics"].df.drop(STAMP)


assert set(_BRONZE_SQL) == set(BRONZE)
