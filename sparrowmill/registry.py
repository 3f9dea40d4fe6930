"""Registry of published queries: a name, a DataFrame builder and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return publish(self.build(Tables(spark, sf_dir)))


_QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, oracle: str | None = None):
    """Register ``build(tables)``; ``covers`` lists the operator ids of the coverage table."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = Query(name, tuple(covers.split()), build, oracle)
        return build

    return register


def publish(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text to the microsecond, decimals as double: the types every client reads alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd").alias(field.name)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def all_queries() -> dict[str, Query]:
    import sparrowmill.catalog  # noqa: F401  (registers every query)

    return dict(_QUERIES)
