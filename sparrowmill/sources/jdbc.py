"""Tables of an operational database."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def connection(env: Mapping[str, str] = os.environ) -> tuple[str, dict[str, str]]:
    """JDBC url and properties from UPSTREAM_HOST, _PORT, _DATABASE, _USERNAME, _PASSWORD."""
    host = env.get("UPSTREAM_HOST", "localhost")
    port = env.get("UPSTREAM_PORT", "5432")
    database = env.get("UPSTREAM_DATABASE", "upstream")
    properties = {
        "user": env.get("UPSTREAM_USERNAME", ""),
        "password": env.get("UPSTREAM_PASSWORD", ""),
        "driver": env.get("UPSTREAM_DRIVER", "org.postgresql.Driver"),
    }
    return f"jdbc:postgresql://{host}:{port}/{database}", properties


def partition_options(
    partition_column: str | None, bounds: tuple | None, num_partitions: int | None
) -> dict[str, str]:
    """Options of a range-partitioned read; all three belong together."""
    if partition_column is None and bounds is None and num_partitions is None:
        return {}
    if partition_column is None or bounds is None or num_partitions is None:
        raise ValueError("a partitioned read needs partition_column, bounds and num_partitions")
    return {
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(num_partitions),
    }


def read_jdbc(
    spark: SparkSession,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table, over many connections when a partition column and its bounds are given.

    The bounds only shape the ranges: rows outside them land in the first and last one.
    """
    url, properties = connection()
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    options = {
        **properties,
        "fetchsize": str(fetch_size),
        **partition_options(partition_column, bounds, num_partitions),
    }
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


# The number column that the ranges of a table's connections run over.
KEYS = {
    "appuser": "user_id", "brand": "brand_id", "buyer": "buyer_id", "category": "category_id",
    "clickstream": "event_id", "manufacturer": "manufacturer_id", "orderitem": "order_item_id",
    "orders": "order_id", "product": "product_id", "productcategory": "product_id",
    "ratings": "ratings_id", "seller": "seller_id", "sellerproduct": "seller_id",
}


def key_bounds(spark: SparkSession, table: str, column: str) -> tuple | None:
    """(least, greatest) value of a column, computed by the database; None for an empty table."""
    query = f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) AS bounds"
    row = read_jdbc(spark, query).head()
    return None if row is None or row["low"] is None else (row["low"], row["high"])


# Tables whose range column is a foreign key, so that equal widths may hold unequal rows.
BRIDGES = ("productcategory", "sellerproduct")


def quantile_query(table: str, column: str, parts: int) -> str:
    """SQL for the values that cut a column into ``parts`` runs of about as many rows."""
    fractions = ", ".join(str(i / parts) for i in range(1, parts))
    return (
        f"(SELECT unnest(percentile_disc(ARRAY[{fractions}]) WITHIN GROUP (ORDER BY {column})) AS cut"
        f" FROM {table}) AS cuts"
    )


def range_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """Conditions that part all rows: up to the first cut (and null), between neighbours, above the last.

    A value that fills several quantiles gets a range of its own, so it is read over one connection.
    """
    bounds = sorted({c for c in cuts if c is not None})
    if not bounds:
        return ["1 = 1"]
    between = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} <= {bounds[0]} OR {column} IS NULL", *between, f"{column} > {bounds[-1]}"]


def read_by_quantiles(spark: SparkSession, table: str, column: str, parts: int) -> DataFrame:
    """Read a table over ``parts`` connections with about as many rows each, cut by the database."""
    cuts = [row["cut"] for row in read_jdbc(spark, quantile_query(table, column, parts)).collect()]
    url, properties = connection()
    return spark.read.jdbc(url, table, predicates=range_predicates(column, cuts), properties=properties)


def upstream_tables(
    spark: SparkSession,
    partitions: Mapping[str, tuple[str, tuple, int]] | None = None,
    connections: int = 16,
) -> Callable[[str], DataFrame]:
    """Tables by name for a pipeline run, each read over ``connections`` connections.

    The ranges run over the table's key, between bounds that the database is asked for, or, where the
    column is a foreign key, at its quantiles;
    ``partitions`` gives (column, bounds, count) of tables that should be read otherwise.
    """

    def table(name: str) -> DataFrame:
        if name in (partitions or {}):
            return read_jdbc(spark, name, *partitions[name])
        if name in BRIDGES:
            return read_by_quantiles(spark, name, KEYS[name], connections)
        bounds = key_bounds(spark, name, KEYS[name])
        if bounds is None:
            return read_jdbc(spark, name)
        return read_jdbc(spark, name, KEYS[name], bounds, connections)

    return table
