"""Result comparison with a tolerance per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Precision names and what they allow.
#   str int cnt  equal
#   num          equal at two decimals
#   sum          within 100
#   avg          within 1 percent
#   rat          within 1
PRECISIONS = ("str", "int", "cnt", "num", "sum", "avg", "rat")


def _cents(value: Column) -> Column:
    return F.round(value.cast("double"), 2)


def _mismatch(actual: Column, expected: Column, precision: str) -> Column:
    if precision == "str":
        return ~F.rtrim(actual.cast("string")).eqNullSafe(F.rtrim(expected.cast("string")))
    if precision in ("int", "cnt"):
        return ~actual.eqNullSafe(expected)
    a, e = _cents(actual), _cents(expected)
    gap = F.abs(a - e)
    if precision == "num":
        off = a != e
    elif precision == "sum":
        off = gap > 100
    elif precision == "avg":
        off = gap > F.abs(a) * 0.01
    else:
        off = gap > 1
    return F.when(a.isNull() | e.isNull(), a.isNull() != e.isNull()).otherwise(off)


def compare_results(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], precision: Mapping[str, str]
) -> DataFrame:
    """Mismatches as (keys, column, actual, expected); a missing row shows as column '(row)'.

    ``keys`` identify a row on both sides. ``precision`` names the tolerance of each other column.
    """
    unknown = set(precision.values()) - set(PRECISIONS)
    if unknown:
        raise ValueError(f"unknown precision {sorted(unknown)}")
    a = actual.select(*[F.col(c).alias(f"a_{c}") for c in [*keys, *precision]], F.lit(1).alias("a_in"))
    e = expected.select(*[F.col(c).alias(f"e_{c}") for c in [*keys, *precision]], F.lit(1).alias("e_in"))
    on = reduce(lambda x, y: x & y, [F.col(f"a_{k}").eqNullSafe(F.col(f"e_{k}")) for k in keys])
    both = F.col("a_in").isNotNull() & F.col("e_in").isNotNull()

    def finding(name: str, left: Column, right: Column, when: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(name).alias("column"),
                left.cast("string").alias("actual"),
                right.cast("string").alias("expected"),
            ),
        )

    presence = finding(
        "(row)",
        F.when(F.col("a_in").isNotNull(), "present"),
        F.when(F.col("e_in").isNotNull(), "present"),
        ~both,
    )
    cells = [
        finding(c, F.col(f"a_{c}"), F.col(f"e_{c}"),
                both & _mismatch(F.col(f"a_{c}"), F.col(f"e_{c}"), p))
        for c, p in precision.items()
    ]
    found = F.explode(F.array_compact(F.array(presence, *cells))).alias("m")
    return a.join(e, on, "full").select(
        *[F.coalesce(F.col(f"a_{k}"), F.col(f"e_{k}")).alias(k) for k in keys], found
    ).select(*keys, "m.*")
