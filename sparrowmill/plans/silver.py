"""Silver layer: dimensions, facts and bridges as pure functions of bronze tables.

No join is hinted: Catalyst broadcasts a side when its size allows it, and adaptive execution
switches at run time or splits a skewed fact partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.functions.columns import disambiguate
from sparrowmill.plans.bronze import STAMP

# Exchange rates of the order totals.
USD_RATE, INR_RATE = 0.014, 70


def _party(user: DataFrame, party: DataFrame, prefix: str) -> DataFrame:
    left, right = disambiguate(user.drop(STAMP), party.drop(STAMP), ["user_id"], "appuser", prefix)
    return left.join(right, "user_id")


# The names that the selects below publish are fixed values: the columns of the published tables.


def dim_buyer(user: DataFrame, buyer: DataFrame) -> DataFrame:
    return _party(user, buyer, "buyer").select(
        "user_id", "username", "email", "is_active",
        "appuser_created_ts", "appuser_last_updated_by", "appuser_last_updated_ts",
        "buyer_id", "first_time_purchased_timestamp",
        "buyer_created_ts", "buyer_last_updated_by", "buyer_last_updated_ts",
    )


def dim_seller(user: DataFrame, seller: DataFrame) -> DataFrame:
    return _party(user, seller, "seller").select(
        "user_id", "username", "email", "is_active",
        "appuser_created_ts", "appuser_last_updated_by", "appuser_last_updated_ts",
        "seller_id", "first_time_sold_timestamp",
        "seller_created_ts", "seller_last_updated_by", "seller_last_updated_ts",
    )


def dim_product(product: DataFrame, brand: DataFrame, manufacturer: DataFrame) -> DataFrame:
    brands = brand.select(
        "brand_id", F.col("name").alias("brand_name"), F.col("country").alias("brand_country")
    )
    makers = manufacturer.select(
        "manufacturer_id",
        F.col("name").alias("manufacturer_name"),
        F.col("type").alias("manufacturer_type"),
    )
    return (
        product.join(brands, "brand_id", "left")
        .join(makers, "manufacturer_id", "left")
        .select(
            "product_id", F.col("name").alias("product_name"), "description", "price",
            "brand_id", "manufacturer_id", "brand_name", "brand_country",
            "manufacturer_name", "manufacturer_type",
        )
    )


def dim_category(category: DataFrame) -> DataFrame:
    return category.select(
        "category_id", F.col("name").alias("category_name"),
        "created_ts", "last_updated_by", "last_updated_ts",
    )


def fact_order_items(order_item: DataFrame) -> DataFrame:
    return order_item.withColumn("actual_price", F.col("base_price") - F.col("tax")).select(
        "order_item_id", "order_id", "product_id", "seller_id", "quantity", "base_price", "tax",
        "actual_price", "created_ts",
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "buyer_id", "order_ts", "total_price",
        (F.col("total_price") * F.lit(USD_RATE)).alias("total_price_usd"),
        (F.col("total_price") * F.lit(INR_RATE)).alias("total_price_inr"),
        "created_ts",
    )


def product_x_category(product_category: DataFrame) -> DataFrame:
    return product_category.select(
        "product_id", "category_id", "created_ts", "last_updated_by", "last_updated_ts"
    )


def seller_x_product(seller_product: DataFrame) -> DataFrame:
    return seller_product.drop(STAMP)
