"""Exact percentiles per group by distributed selection over counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.operators.skew import HOT_ROWS, apart, has_hot_key, same

# A doubling of the value is cut into so many first bands, and a first band into so many second ones.
FIRST, SECOND = 32, 1024
# Input files up to so many bytes hold no group that one task could not sort, spilling.
SORTED_BYTES = 1 << 30


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` is made from, as far as the file listing tells; no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys under ``p_`` names, to join by null-safe equality."""
    return df.withColumnsRenamed({k: f"p_{k}" for k in keys})


def _reaching(counts: DataFrame, by: Sequence[str], order: str, need: Column) -> DataFrame:
    """Per group the row, in ascending ``order``, at which the sum of ``n`` reaches ``need``, with the sum
    before it. A group that needs nothing has one row, without a value."""
    so_far = F.sum("n").over(Window.partitionBy(*by).orderBy(order))
    marked = counts.withColumns({"need": need, "before": so_far - F.col("n")})
    reached = (F.col("before") < F.col("need")) & (F.col("before") + F.col("n") >= F.col("need"))
    return marked.where(reached | (F.col("need") == 0))


def percentile(
    df: DataFrame, by: Sequence[str], value: str, fraction: float = 0.5, name: str = "median",
    mean: str | None = None, carried: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per group the least value that at least ``fraction`` of the group's non-null values do not exceed.

    Returns ``by``, ``name`` and, where ``mean`` names it, the mean of the values (exact sums for
    decimals). Groups without values have nulls; null keys are keys. ``carried`` columns, which ``by``
    determines, come along without being compared.

    Where no group can be large, because the input is not or because no group has more than ``hot_rows``
    rows, each group is sorted in one task, which spills; otherwise ``selected_percentile`` is taken.
    """
    if input_bytes(df) <= SORTED_BYTES or not has_hot_key(df, by, hot_rows):
        return sorted_percentile(df, by, value, fraction, name, mean, carried)
    return selected_percentile(df, by, value, fraction, name, mean, carried)


def sorted_percentile(
    df: DataFrame, by: Sequence[str], value: str, fraction: float, name: str, mean: str | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """``percentile`` by numbering each group's values: one shuffle and one sort."""
    along = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = F.count(value).over(whole)
    means = {mean: F.when(held > 0, F.sum(value).over(whole).cast("double") / held)} if mean else {}
    middle = F.greatest(F.ceil(held * F.lit(fraction)), F.lit(1))
    numbered = df.select(*by, *carried, value).withColumns(
        {"nth": F.row_number().over(along), "middle": middle, **means}
    )
    return numbered.where("nth = middle").select(*by, *carried, F.col(value).alias(name), *means)


def selected_percentile(
    df: DataFrame, by: Sequence[str], value: str, fraction: float, name: str, mean: str | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """``percentile`` by distributed selection, for groups of any size.

    Rows are first counted per group and value, combined map-side. Histograms over bands that grow with
    the value then tell in which band each group's percentile lies, first in bands of equal ratio, then
    in bands of equal width inside the one that was found. A group has at most a few thousand bands, and
    only one band's values are ever sorted, so neither many groups nor a group that holds most rows or
    very many values needs memory for it.
    """
    by = list(by)
    counted = df.groupBy(*by, *carried, F.col(value).alias("value")).agg(F.count(value).alias("n"))
    number = F.col("value").cast("double")
    counted = counted.withColumn("band", F.signum(number) * F.floor(F.log2(F.abs(number) + 1) * FIRST))
    total = [F.sum(F.col("value") * F.col("n")).alias("sum")] if mean else []
    bands = counted.groupBy(*by, "band").agg(
        F.sum("n").alias("n"), F.min(number).alias("low"), F.max(number).alias("high"), *total
    )
    group = Window.partitionBy(*by)
    bands = bands.withColumn("all", F.sum("n").over(group))
    if mean:
        of_group = F.sum("sum").over(group).cast("double")
        bands = bands.withColumn(mean, F.when(F.col("all") > 0, of_group / F.col("all")))
    need = F.when(F.col("all") == 0, 0).otherwise(F.greatest(F.ceil(F.col("all") * F.lit(fraction)), F.lit(1)))
    means = [mean] if mean else []
    found = _reaching(bands, by, "band", need.cast("long"))
    found = _renamed(
        found.select(*by, "band", "low", "high", (F.col("need") - F.col("before")).alias("rest"), *means),
        [*by, "band"],
    )
    # A group may have most of the counts: its rows are split over tasks where they meet its band.
    inside = counted.join(apart(found), same(counted, found, [*by, "band"], "p_"))
    width = (F.col("high") - F.col("low")) / F.lit(SECOND)
    slot = F.when(width > 0, F.floor((number - F.col("low")) / width)).otherwise(0).cast("long")
    inside = inside.select(*by, *carried, slot.alias("slot"), "value", "n", "rest", *means)

    slots = inside.groupBy(*by, "slot").agg(F.sum("n").alias("n"), F.max("rest").alias("rest"))
    found = _reaching(slots, by, "slot", F.col("rest"))
    found = _renamed(
        found.select(*by, "slot", (F.col("need") - F.col("before")).alias("left")), [*by, "slot"]
    )
    last = inside.join(apart(found), same(inside, found, [*by, "slot"], "p_"))
    last = _reaching(last.select(*by, *carried, "value", "n", "left", *means), by, "value", F.col("left"))
    return last.select(*by, *carried, F.col("value").alias(name), *means)
