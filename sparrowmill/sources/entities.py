"""The thirteen operational tables, derived from the benchmark tables.

Each is a lazy DataFrame in the shape of the upstream table it stands for. A run against a real
database passes ``sources.jdbc.read_jdbc`` frames instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.sources.tables import Tables

# Category names in id order, and the size limits of the two size categories.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "POCKET", "COMPACT")
POCKET_SIZE, COMPACT_SIZE = 10, 25

FIXED_TS = "2024-01-01 00:00:00"


def _ts() -> Column:
    return F.lit(FIXED_TS).cast("timestamp_ntz")


def _audited(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"created_ts": _ts(), "last_updated_by": F.lit(0), "last_updated_ts": _ts()}
    )


def _price(column: str) -> Column:
    return F.col(column).cast("decimal(10,2)")


def app_user(t: Tables) -> DataFrame:
    """Customers take the even user ids, suppliers the odd ones."""

    def users(df: DataFrame, key: str, name: str, balance: str, odd: int) -> DataFrame:
        return df.select(
            (F.col(key) * 2 + odd).alias("user_id"),
            F.col(name).alias("username"),
            F.concat(F.lower(name), F.lit("@example.com")).alias("email"),
            (F.col(balance) > 0).alias("is_active"),
        )

    both = users(t.customer, "c_custkey", "c_name", "c_acctbal", 0).unionByName(
        users(t.supplier, "s_suppkey", "s_name", "s_acctbal", 1)
    )
    return _audited(both)


def buyer(t: Tables) -> DataFrame:
    return _audited(
        t.customer.select(
            F.col("c_custkey").alias("buyer_id"),
            (F.col("c_custkey") * 2).alias("user_id"),
            _ts().alias("first_time_purchased_timestamp"),
        )
    )


def seller(t: Tables) -> DataFrame:
    return _audited(
        t.supplier.select(
            F.col("s_suppkey").alias("seller_id"),
            (F.col("s_suppkey") * 2 + 1).alias("user_id"),
            _ts().alias("first_time_sold_timestamp"),
        )
    )


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("buyer_id"),
        F.col("o_orderdate").alias("order_ts"),
        _price("o_totalprice").alias("total_price"),
        F.col("o_orderdate").alias("created_ts"),
    )


def order_item_id() -> Column:
    """The shortest key that is unique in lineitem."""
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return F.concat_ws("-", *keys, F.date_format("l_shipdate", "yyyyMMdd"))


def order_item(t: Tables) -> DataFrame:
    tax = F.round(_price("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)"), 2)
    return t.lineitem.select(
        order_item_id().alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _price("l_extendedprice").alias("base_price"),
        tax.cast("decimal(10,2)").alias("tax"),
        F.col("l_shipdate").alias("created_ts"),
    )


def _brand_number() -> Column:
    return F.split("p_brand", "#")[1].cast("int")


def brand(t: Tables) -> DataFrame:
    brands = t.part.select(
        _brand_number().alias("brand_id"),
        F.col("p_brand").alias("name"),
        F.concat(F.lit("COUNTRY_"), (_brand_number() % 5).cast("string")).alias("country"),
    )
    return _audited(brands.distinct())


def _maker_number() -> Column:
    return (F.col("p_partkey") % 5 + 1).cast("int")


def manufacturer(t: Tables) -> DataFrame:
    number = _maker_number()
    makers = t.part.select(
        number.alias("manufacturer_id"),
        F.concat(F.lit("Manufacturer#"), number.cast("string")).alias("name"),
        F.concat(F.lit("TYPE_"), (number % 2).cast("string")).alias("type"),
    )
    return _audited(makers.distinct())


def product(t: Tables) -> DataFrame:
    return _audited(
        t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
            _price("p_retailprice").alias("price"),
            _brand_number().alias("brand_id"),
            _maker_number().alias("manufacturer_id"),
        )
    )


def _category_names() -> Column:
    """The one or two category names of a part."""
    by_size = F.when(F.col("p_size") <= POCKET_SIZE, "POCKET").when(
        F.col("p_size") <= COMPACT_SIZE, "COMPACT"
    )
    return F.array_compact(F.array(F.col("p_type"), by_size))


def _category_id(name: str) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col(name)).cast("int")


def category(t: Tables) -> DataFrame:
    names = t.part.select(F.explode(_category_names()).alias("name")).distinct()
    return _audited(names.select(_category_id("name").alias("category_id"), "name"))


def product_category(t: Tables) -> DataFrame:
    pairs = t.part.select(
        F.col("p_partkey").alias("product_id"), F.explode(_category_names()).alias("name")
    )
    return _audited(pairs.select("product_id", _category_id("name").alias("category_id")))


def ratings(t: Tables) -> DataFrame:
    return _audited(
        t.lineitem.select(
            order_item_id().alias("ratings_id"),
            F.col("l_partkey").alias("product_id"),
            (F.col("l_quantity").cast("decimal(4,1)") * F.lit("0.1").cast("decimal(2,1)"))
            .cast("decimal(3,2)")
            .alias("rating"),
        )
    )


def seller_product(t: Tables) -> DataFrame:
    pairs = t.lineitem.select(
        F.col("l_suppkey").alias("seller_id"), F.col("l_partkey").alias("product_id")
    )
    return _audited(pairs.distinct())


def clickstream(t: Tables) -> DataFrame:
    """Every event; views and clicks refer to a product, purchases to an order."""
    return t.events.select(
        "event_id",
        "user_id",
        "event_type",
        F.when(F.col("event_type").isin("view", "click"), F.col("event_id")).alias("product_id"),
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("order_id"),
        F.col("ts").alias("timestamp"),
        F.col("ts").alias("created_ts"),
    )


ENTITIES: dict[str, Callable[[Tables], DataFrame]] = {
    "appuser": app_user,
    "brand": brand,
    "buyer": buyer,
    "category": category,
    "clickstream": clickstream,
    "manufacturer": manufacturer,
    "orderitem": order_item,
    "orders": orders,
    "product": product,
    "productcategory": product_category,
    "ratings": ratings,
    "seller": seller,
    "sellerproduct": seller_product,
}
