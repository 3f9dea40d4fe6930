"""Bronze layer: one table per upstream table, stamped with the run's time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAMP = "etl_inserted"
AUDIT = ("created_ts", "last_updated_by", "last_updated_ts")


@dataclass(frozen=True)
class TableSpec:
    """Name of the dataset, its upstream table, key and published columns."""

    name: str
    source: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]


# Published columns of each bronze table.
BRONZE = {
    spec.name: spec
    for spec in (
        TableSpec("user", "appuser", ("user_id",),
                  ("user_id", "username", "email", "is_active", *AUDIT)),
        TableSpec("brand", "brand", ("brand_id",), ("brand_id", "name", "country", *AUDIT)),
        TableSpec("buyer", "buyer", ("buyer_id",),
                  ("buyer_id", "user_id", "first_time_purchased_timestamp", *AUDIT)),
        TableSpec("category", "category", ("category_id",), ("category_id", "name", *AUDIT)),
        TableSpec("clickstream", "clickstream", ("event_id",),
                  ("event_id", "user_id", "event_type", "product_id", "order_id", "timestamp",
                   "created_ts")),
        TableSpec("manufacturer", "manufacturer", ("manufacturer_id",),
                  ("manufacturer_id", "name", "type", *AUDIT)),
        TableSpec("order_item", "orderitem", ("order_item_id",),
                  ("order_item_id", "order_id", "product_id", "seller_id", "quantity",
                   "base_price", "tax", "created_ts")),
        TableSpec("orders", "orders", ("order_id",),
                  ("order_id", "buyer_id", "order_ts", "total_price", "created_ts")),
        TableSpec("product", "product", ("product_id",),
                  ("product_id", "name", "description", "price", "brand_id", "manufacturer_id",
                   *AUDIT)),
        TableSpec("product_category", "productcategory", ("product_id", "category_id"),
                  ("product_id", "category_id", *AUDIT)),
        TableSpec("ratings", "ratings", ("ratings_id",),
                  ("ratings_id", "product_id", "rating", *AUDIT)),
        TableSpec("seller", "seller", ("seller_id",),
                  ("seller_id", "user_id", "first_time_sold_timestamp", *AUDIT)),
        TableSpec("seller_product", "sellerproduct", ("seller_id", "product_id"),
                  ("seller_id", "product_id")),
    )
}


def stamp(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumn(STAMP, F.lit(run_ts).cast("timestamp_ntz"))


def bronze(spec: TableSpec, df: DataFrame, run_ts: str) -> DataFrame:
    """The upstream rows unchanged, narrowed to the published columns and stamped."""
    return stamp(df.select(*spec.columns), run_ts)
