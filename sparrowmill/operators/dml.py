"""Insert, delete, update, merge and refresh as rewrites: each returns the table's next version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.operators.joins import anti
from sparrowmill.operators.skew import apart, assert_unique
from sparrowmill.sources.files import delete_folder, text_format, without_mark


class CatalogTable:
    """A table of the session's catalog over files of its own: create, insert, delete all, drop.

    The files are Parquet, or separated text with ``using="csv"``, under ``path``. ``options`` of the
    format are kept with the table and hold for every INSERT and SELECT; those of a text table are
    ``files.text_format`` unless given. Dropping the table removes it from the catalog and leaves the
    files, unless ``purge`` is asked for.
    """

    def __init__(
        self, spark: SparkSession, name: str, schema: T.StructType | str, path: str, using: str = "parquet",
        options: Mapping[str, str] | None = None,
    ):
        if using not in ("parquet", "csv"):
            raise ValueError("using must be parquet or csv")
        self.spark, self.name, self.path, self.using = spark, name, path, using
        if options is None:
            options = text_format() if using == "csv" else {}
        typed = spark.createDataFrame([], schema).schema
        spark.catalog.createTable(name, path=path, source=using, schema=typed, **options)

    def insert_values(self, *rows: Sequence[object]) -> None:
        """INSERT INTO ... VALUES; values travel as parameters."""
        places = ", ".join("(" + ", ".join("?" for _ in row) + ")" for row in rows)
        self.spark.sql(f"INSERT INTO `{self.name}` VALUES {places}", args=[v for r in rows for v in r])

    def insert_select(self, rows: DataFrame) -> None:
        """INSERT INTO ... SELECT; columns match by position and take the table's types."""
        typed = insert_into(self.read().limit(0), rows)
        (without_mark(typed) if self.using == "csv" else typed).write.insertInto(self.name)

    def delete_all(self) -> None:
        """DELETE without a condition, which plain files offer as INSERT OVERWRITE of no rows."""
        none = self.spark.createDataFrame([], self.read().schema)
        none.write.insertInto(self.name, overwrite=True)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self, purge: bool = False) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")
        if purge:
            delete_folder(self.spark, self.path)


def insert_into(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT INTO ... SELECT: columns match by position, as in SQL, and take the target's types."""
    if len(rows.columns) != len(target.columns):
        raise ValueError("insert needs as many columns as the target has")
    typed = rows.toDF(*target.columns).select(
        *[F.col(f.name).cast(f.dataType) for f in target.schema.fields]
    )
    return target.unionByName(typed)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE WHERE: rows for which the condition is false or unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """UPDATE SET ... WHERE; every new value is computed from the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(hit, changes[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in changes
            else F.col(c)
            for c in df.columns
        ]
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
) -> DataFrame:
    """MERGE: matched rows take ``update``, source rows without a match are added as ``insert``.

    Expressions name source columns as ``s_<column>`` and target columns plainly. A repeated
    source key fails the job; null keys match nothing and are inserted, however many. Matched and inserted rows come from two joins, each of which Spark
    can split where the target holds one key very often; a full outer join could not be split.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    unkeyed = source.filter(~keyed)
    source = apart(assert_unique(source.filter(keyed), keys, "merge source")).unionByName(unkeyed)
    source = source.select(
        *[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("s__hit")
    )
    on = [F.col(k) == F.col(f"s_{k}") for k in keys]
    joined = target.join(source, on, "left")
    hit = F.col("s__hit").isNotNull()
    kept = joined.select(
        *[
            F.when(hit, update[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ]
    )
    known = target.select(*keys).distinct()
    fresh = source.join(known, on, "left_anti").select(
        *[
            insert.get(c, F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    return kept.unionByName(fresh)


def evolve(
    df: DataFrame, add: Mapping[str, str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """ALTER TABLE ADD / DROP COLUMN: new columns start as null."""
    return df.drop(*drop).withColumns(
        {name: F.lit(None).cast(kind) for name, kind in (add or {}).items()}
    )


def apply_refresh(
    orders: DataFrame,
    lineitem: DataFrame,
    new_orders: DataFrame | None = None,
    new_lineitem: DataFrame | None = None,
    delete_keys: DataFrame | None = None,
    order_key: str = "o_orderkey",
    line_key: str = "l_orderkey",
) -> tuple[DataFrame, DataFrame]:
    """The two refresh functions: add new orders with their lines, drop orders by key list."""
    if new_orders is not None:
        orders = orders.unionByName(new_orders)
    if new_lineitem is not None:
        lineitem = lineitem.unionByName(new_lineitem)
    if delete_keys is not None:
        doomed = delete_keys.toDF("__key")
        orders = anti(orders, doomed, {order_key: "__key"})
        lineitem = anti(lineitem, doomed, {line_key: "__key"})
    return orders, lineitem
