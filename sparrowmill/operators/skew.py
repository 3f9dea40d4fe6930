"""Handling of hot keys: groups so large that one task must never hold them whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group up to this many rows fits one task. Beyond it the key is hot and its rows are split.
HOT_ROWS = 1_000_000


def same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "") -> Column:
    """Null-safe equality on the keys; the right frame's keys may carry a prefix."""
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys], F.lit(True)
    )


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, under ``__hot_<key>`` names.

    Counts combine map-side, so a hot key reaches the shuffle once per task. The result holds at
    most (rows of df) / hot_rows keys, which is what makes broadcasting it safe.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.filter(F.col("__rows") > hot_rows).select(
        *[F.col(k).alias(f"__hot_{k}") for k in keys]
    )


def has_hot_key(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> bool:
    """Whether some key has more than ``hot_rows`` rows; one value comes back.

    A table of no more rows than that is only counted, which Parquet footers tell.
    """
    return df.count() > hot_rows and bool(hot_keys(df, keys, hot_rows).head(1))


def hot_keys_in_crowds(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """``hot_keys``, or None without any; a table of mostly different keys does not shuffle them.

    Rows are counted by a hash of their key first, eight hashes for every ``hot_rows`` rows. Only rows
    whose hash is hot, if there is one, are counted by key. Beyond 10^6 times ``hot_rows`` rows a key
    needs a millionth of them to be hot, so that a million keys at most are broadcast.
    """
    rows = df.count()
    if rows <= hot_rows:
        return None
    hot_rows = max(hot_rows, rows // 1_000_000)
    cell = F.pmod(F.xxhash64(*keys), F.lit(-(-rows // hot_rows) * 8)).alias("__cell")
    celled = df.select(*keys, cell)
    crowded = hot_keys(celled, ["__cell"], hot_rows)
    if not crowded.head(1):
        return None
    near = celled.join(F.broadcast(crowded), F.col("__cell") == F.col("__hot___cell"), "left_semi")
    hot = hot_keys(near, keys, hot_rows)
    return hot if hot.head(1) else None


def apart(df: DataFrame) -> DataFrame:
    """A small-per-key join input, set apart by a shuffle so that the join shuffles it again.

    Adaptive execution splits a hot partition only where both join inputs come straight from the
    join's own shuffles. The result of an aggregate or join on the same key has no such shuffle,
    and would leave the other side's hot key whole.
    """
    return df.hint("rebalance")


def occurs_again(what: str, keys: Sequence[str]) -> Column:
    """An expression that fails the job and names the key of the row at hand."""
    return F.raise_error(
        F.concat(
            F.lit(f"{what}: key "), F.to_json(F.struct(*[F.col(k) for k in keys])),
            F.lit(" occurs more than once"),
        )
    )


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` again, failing the job when a key occurs twice. One row per key, no hot groups left.

    Rows are numbered per key, in one shuffle and one sort that a join on the keys can go on with.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    checked = F.when(F.col("__copy") == 1, True).otherwise(occurs_again(what, keys).cast("boolean"))
    return df.withColumn("__copy", number).filter(checked).select(*df.columns)
