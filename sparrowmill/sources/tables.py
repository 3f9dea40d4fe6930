"""The benchmark tables of one directory, read lazily, plus the columns derived from them.

The derived columns stand in for the ones the fixture lacks. They are plain expressions, so a
query over them still prunes columns and pushes filters into the parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.functions.exact import money

# Text choices of the derived columns, in index order.
SHIP_MODES = ("AIR", "AIR REG", "REG AIR", "MAIL", "SHIP", "TRUCK", "RAIL", "FOB")
SHIP_INSTRUCTIONS = ("DELIVER IN PERSON", "COLLECT COD", "NONE", "TAKE BACK RETURN")
CONTAINER_SIZES = ("SM", "MED", "LG", "JUMBO", "WRAP")
CONTAINER_KINDS = ("CASE", "BOX", "PACK", "PKG")


def choose(index: Column, values: tuple[str, ...]) -> Column:
    """The text at a zero-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def line_details() -> dict[str, Column]:
    """Commit and receipt dates, ship mode and ship instruction of a line."""
    ship_day = F.to_date("l_shipdate")
    commit_lag = ((F.col("l_partkey") * 7 + F.col("l_linenumber") * 13) % 61 - 30).cast("int")
    receipt_lag = ((F.col("l_suppkey") * 11 + F.col("l_orderkey")) % 30 + 1).cast("int")
    return {
        "l_commitdate": F.date_add(ship_day, commit_lag),
        "l_receiptdate": F.date_add(ship_day, receipt_lag),
        "l_shipmode": choose((F.col("l_orderkey") + F.col("l_linenumber")) % 8, SHIP_MODES),
        "l_shipinstruct": choose((F.col("l_partkey") + F.col("l_linenumber")) % 4, SHIP_INSTRUCTIONS),
    }


def customer_details() -> dict[str, Column]:
    """A customer's phone number."""
    phone = F.concat_ws(
        "-",
        (F.col("c_nationkey") + 10).cast("string"),
        F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"),
        F.lpad((F.col("c_custkey") * 7 % 10000).cast("string"), 4, "0"),
    )
    return {"c_phone": phone}


def order_details() -> dict[str, Column]:
    """Ship priority, clerk, comment and a buyer that some customers never are."""
    clerk = F.concat(F.lit("Clerk#"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 9, "0"))
    comment = F.when(F.col("o_orderkey") % 50 == 0, "special packages requests").otherwise(
        "regular deposits"
    )
    # As in the benchmark, no customer whose key divides by three has orders.
    buyer = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return {"o_shippriority": F.lit(0), "o_clerk": clerk, "o_comment": comment, "o_buyerkey": buyer}


def part_details() -> dict[str, Column]:
    """A part's container and manufacturer."""
    container = F.concat_ws(
        " ",
        choose(F.col("p_partkey") % 5, CONTAINER_SIZES),
        choose(F.col("p_partkey") % 4, CONTAINER_KINDS),
    )
    maker = F.concat(F.lit("Manufacturer#"), (F.col("p_partkey") % 5 + 1).cast("string"))
    return {"p_container": container, "p_mfgr": maker}


def supplier_details() -> dict[str, Column]:
    """A supplier's comment."""
    comment = F.when(F.col("s_suppkey") % 20 == 7, "Customer slow Complaints").otherwise("steady")
    return {"s_comment": comment}


def stock_details(part_key: Column, supp_key: Column) -> dict[str, Column]:
    """Quantity in stock and cost of a (part, supplier) pair."""
    cost = ((part_key * 53 + supp_key * 17) % 99900 + 100).cast("decimal(10,0)")
    return {
        "ps_availqty": ((part_key * 37 + supp_key * 101) % 9999 + 1).cast("int"),
        "ps_supplycost": (cost * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(15,2)"),
    }


class Tables:
    """``tables.orders`` and so on are lazy DataFrames over ``<directory>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = str(directory).rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    region = cached_property(lambda self: self.read("region"))
    nation = cached_property(lambda self: self.read("nation"))
    customer = cached_property(lambda self: self.read("customer"))
    supplier = cached_property(lambda self: self.read("supplier"))
    part = cached_property(lambda self: self.read("part"))
    orders = cached_property(lambda self: self.read("orders"))
    lineitem = cached_property(lambda self: self.read("lineitem"))
    events = cached_property(lambda self: self.read("events"))

    @cached_property
    def lineitem_x(self) -> DataFrame:
        """lineitem with commit and receipt dates, ship mode and ship instruction."""
        return self.lineitem.withColumns(line_details())

    @cached_property
    def partsupp(self) -> DataFrame:
        """One row per (part, supplier) pair that was ever shipped."""
        keys = self.lineitem.select(
            F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
        )
        return keys.distinct().withColumns(stock_details(F.col("ps_partkey"), F.col("ps_suppkey")))

    @cached_property
    def customer_x(self) -> DataFrame:
        """customer with a phone number."""
        return self.customer.withColumns(customer_details())

    @cached_property
    def orders_x(self) -> DataFrame:
        """orders with ship priority, clerk, comment and a buyer that some customers never are."""
        return self.orders.withColumns(order_details())

    @cached_property
    def part_x(self) -> DataFrame:
        """part with container and manufacturer."""
        return self.part.withColumns(part_details())

    @cached_property
    def supplier_x(self) -> DataFrame:
        """supplier with a comment."""
        return self.supplier.withColumns(supplier_details())

    @cached_property
    def order_totals(self) -> DataFrame:
        """orders with an exact decimal total, for the reports that add money up."""
        return self.orders.withColumn("total", money("o_totalprice"))
