"""Gold layer: wide tables, daily metrics and the report views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.functions.exact import mean
from sparrowmill.operators.percentiles import percentile
from sparrowmill.operators.skew import apart
from sparrowmill.plans.bronze import STAMP


def wide_orders(
    fact_orders: DataFrame, party: DataFrame, on: tuple[str, str] = ("buyer_id", "seller_id")
) -> DataFrame:
    """Orders with their party's user data. ``on`` pairs the order's key with the party's.

    The default pairs buyer_id with the seller dimension; pass the buyer dimension and
    ("buyer_id", "buyer_id") for the buyer's data.
    """
    order_key, party_key = on
    who = party.drop(STAMP).withColumnRenamed(party_key, "__party")
    joined = fact_orders.drop(STAMP).join(who, F.col(order_key) == F.col("__party"), "left")
    if order_key == party_key:
        return joined.drop("__party")
    return joined.withColumnRenamed("__party", party_key)


def product_categories(product_x_category: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Per product the sorted array of its categories, at most one entry per category."""
    return (
        product_x_category.select("product_id", "category_id")
        .distinct()
        .join(dim_category.select("category_id", "category_name"), "category_id")
        .groupBy("product_id")
        .agg(F.sort_array(F.collect_list(F.struct("category_id", "category_name"))).alias("categories"))
    )


def wide_order_items(
    fact_order_items: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    product_x_category: DataFrame,
    dim_category: DataFrame,
) -> DataFrame:
    """Order items with product, seller and category array; the fact keeps its grain.

    Categories join the product dimension first, so the fact meets the product key once.
    """
    products = dim_product.drop(STAMP).join(
        product_categories(product_x_category, dim_category), "product_id", "left"
    )
    # No node reads the sellers' further columns, so only the flag travels with the fact.
    sellers = dim_seller.select("seller_id", "is_active")
    return (
        fact_order_items.drop(STAMP)
        .join(apart(products), "product_id", "left")
        .join(sellers, "seller_id", "left")
        .select(
            "order_item_id", "order_id", "product_id", "seller_id", "quantity", "base_price",
            "actual_price", "created_ts", "tax", "categories", "is_active",
        )
    )


def daily_order_metrics(wide_orders: DataFrame) -> DataFrame:
    """Sum and mean of the order totals per day, active parties only (unknown counts as not)."""
    return (
        wide_orders.filter("is_active")
        .groupBy(F.to_date("order_ts").alias("order_date"))
        .agg(
            F.sum("total_price").alias("total_price_sum"),
            mean(F.col("total_price")).alias("total_price_mean"),
        )
    )


def daily_category_metrics(wide_order_items: DataFrame) -> DataFrame:
    """Mean and median price per day and category, active sellers only.

    Items without a category drop out, as explode drops empty arrays.
    """
    items = wide_order_items.filter("is_active").select(
        F.to_date("created_ts").alias("order_date"),
        F.explode("categories").alias("category"),
        "actual_price",
    )
    # Groups are told apart by the id; the name comes along.
    found = percentile(
        items.withColumn("category_id", F.col("category.category_id")), ["order_date", "category_id"],
        "actual_price", 0.5, "median_actual_price", "mean_actual_price", carried=["category"],
    )
    return found.select("order_date", "category", "mean_actual_price", "median_actual_price")


def daily_order_report(metrics: DataFrame, view: str = "daily_order_report") -> DataFrame:
    """Publish the order metrics as a global view under display names."""
    metrics.select(
        F.col("order_date").alias("Date"),
        F.col("total_price_sum").alias("Revenue"),
        F.col("total_price_mean").alias("Mean Revenue"),
    ).createOrReplaceGlobalTempView(view)
    return metrics.sparkSession.table(f"global_temp.{view}")


def daily_category_report(metrics: DataFrame, view: str = "daily_category_report") -> DataFrame:
    """Publish the category metrics as a global view under display names."""
    metrics.select(
        F.col("order_date").alias("Date"),
        F.col("category").alias("Product Category"),
        F.col("mean_actual_price").alias("Mean Revenue"),
        F.col("median_actual_price").alias("Median Revenue"),
    ).createOrReplaceGlobalTempView(view)
    return metrics.sparkSession.table(f"global_temp.{view}")


def scd_users_report(history: DataFrame, view: str = "scd_users_report") -> DataFrame:
    """Publish the user history as a global view."""
    history.select(
        "id", "is_active", "start_date", "end_date", "name", "age"
    ).createOrReplaceGlobalTempView(view)
    return history.sparkSession.table(f"global_temp.{view}")
