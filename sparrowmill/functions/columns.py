"""Column expressions and renames used across the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucketize(
    value: Column | str,
    bands: Sequence[tuple[str, float | None, float | None]],
    otherwise: str,
) -> Column:
    """Label a number by the first band (label, low, high) that holds it, both ends included."""
    value = F.col(value) if isinstance(value, str) else value
    chain = None
    for label, low, high in bands:
        test = F.lit(True)
        if low is not None:
            test = test & (value >= low)
        if high is not None:
            test = test & (value <= high)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(otherwise) if chain is not None else F.lit(otherwise)


def disambiguate(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_prefix: str, right_prefix: str
) -> tuple[DataFrame, DataFrame]:
    """Prefix the columns both frames share, other than the join keys."""
    shared = [c for c in left.columns if c in set(right.columns) and c not in set(keys)]
    return (
        left.withColumnsRenamed({c: f"{left_prefix}_{c}" for c in shared}),
        right.withColumnsRenamed({c: f"{right_prefix}_{c}" for c in shared}),
    )


def month_start(value: Column | str) -> Column:
    """First day of the month as a DATE, so months sort by time and not as text."""
    return F.trunc(F.col(value) if isinstance(value, str) else value, "MM")


def in_year(value: Column | str, start: str, months: int = 12) -> Column:
    """Half-open range [start, start + months) that pushes down to the scan."""
    value = F.col(value) if isinstance(value, str) else value
    first = F.lit(start).cast("date")
    return (value >= first) & (value < F.add_months(first, months))
