"""Aggregation operators: grouping sets and pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouping_sets(
    df: DataFrame, sets: Sequence[Sequence[str]], aggs: Mapping[str, Column], value: str | None = None
) -> DataFrame:
    """GROUPING SETS over column names; columns outside a set are null in its rows.

    GROUPING SETS copies every input row once per set. With ``value`` the rows are first summed
    to the union of all sets, so only those sums are copied; ``aggs`` then read the sums.
    """
    columns = list(dict.fromkeys(c for group in sets for c in group))
    if value is not None:
        df = df.groupBy(*columns).agg(F.sum(value).alias(value))
    grouped = df.groupingSets([[F.col(c) for c in group] for group in sets], *columns)
    return grouped.agg(*[agg.alias(name) for name, agg in aggs.items()])


def pivot_table(
    df: DataFrame, index: Sequence[str], column: str, values: Mapping[str, str], agg: Column
) -> DataFrame:
    """One column per listed value (value -> output name); the list saves the distinct scan."""
    names = list(values)
    pivoted = df.groupBy(*index).pivot(column, names).agg(agg)
    return pivoted.select(*index, *[F.col(f"`{v}`").alias(values[v]) for v in names])
