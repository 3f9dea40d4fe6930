"""Exact money arithmetic: decimals add up the same in any partition order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    return _col(value).cast("decimal(12,2)")


def rate(value: Column | str) -> Column:
    return _col(value).cast("decimal(4,2)")


def discounted(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """price x (1 - discount)."""
    return money(price) * (F.lit(1) - rate(discount))


def charged(
    price: str = "l_extendedprice", discount: str = "l_discount", tax: str = "l_tax"
) -> Column:
    """price x (1 - discount) x (1 + tax)."""
    return discounted(price, discount) * (F.lit(1) + rate(tax))


def mean(value: Column) -> Column:
    """Aggregate: exact sum over count of the non-null values, as double."""
    return F.sum(value).cast("double") / F.count(value)


def scaled(total: Column, factor: str, places: int = 2) -> Column:
    """round(total x factor, places) kept in decimal, e.g. factor '0.001' for thousands."""
    digits = len(factor.partition(".")[2])
    return F.round(total * F.lit(factor).cast(f"decimal({digits + 1},{digits})"), places)
