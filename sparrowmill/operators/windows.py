"""Window operators that stay exact when one partition key holds a large share of all rows.

A plain ``Window.partitionBy(key)`` sorts each key inside one task. That is right for ordinary
keys and is what a table without hot keys gets. A table with a hot key is sorted in ranges once, by
key and order together (see ``ranges``), and windows run per range and key:

* Ranks, row numbers and running sums are associative, so what a range lacks are the totals of the
  key and of the tie that its first rows continue, and the sums of the tie that its last rows open.
  One row per range carries them over.
* Frames of a few ROWS get as many neighbours as they reach from the ranges next to them.

``cumulative`` is for input that is cut by ``bands`` known beforehand: expressions that grow with the
order columns, for example ``floor(price / 1000)``. A chunk is one value of all bands.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.operators.ranges import GUEST, INDEX, PART, sorted_ranges
from sparrowmill.operators.skew import HOT_ROWS, has_hot_key, same

Order = Sequence[tuple[str, str]]
Bands = Sequence[tuple[Column, str]]


def _sorted(order: Order) -> list[Column]:
    return [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]


def _add(earlier: Column, here: Column) -> Column:
    """earlier + here, null only when both are."""
    return F.when(
        earlier.isNotNull() | here.isNotNull(),
        F.coalesce(earlier, F.lit(0)) + F.coalesce(here, F.lit(0)),
    )


def cumulative(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    bands: Bands,
    sums: Mapping[str, str],
    last: int = 0,
) -> DataFrame:
    """Running sums over rows whose ``order`` is unique per ``by``, computed chunk by chunk.

    A chunk is one value of all bands; what the chunks before it add is found in the same way from
    the chunk totals and one band less, so no task ever holds more rows than one band has values.
    ``by`` may be empty. ``last`` is 0 to count the row itself in, -1 to leave it out.
    """
    if not bands:
        window = Window.partitionBy(*by).orderBy(*_sorted(order))
        window = window.rowsBetween(Window.unboundedPreceding, last)
        return df.withColumns({new: F.sum(col).over(window) for new, col in sums.items()})
    names = [f"__band{i}" for i in range(len(bands))]
    chunk = [*by, *names]
    banded = df.withColumns({n: band for n, (band, _) in zip(names, bands)})
    local = cumulative(banded, chunk, order, [], sums, last)
    totals = banded.groupBy(*chunk).agg(*[F.sum(col).alias(f"__t_{new}") for new, col in sums.items()])
    ways = [way for _, way in bands]
    before = cumulative(
        totals,
        by,
        list(zip(names, ways)),
        [(F.col(n), way) for n, way in zip(names[:-1], ways)],
        {f"__before_{new}": f"__t_{new}" for new in sums},
        last=-1,
    ).select(
        *[F.col(k).alias(f"__c_{k}") for k in chunk], *[f"__before_{new}" for new in sums]
    )
    joined = local.join(before, same(local, before, chunk, "__c_"), "left")
    filled = [
        _add(F.col(f"__before_{new}"), F.col(new)).cast(local.schema[new].dataType).alias(new)
        for new in sums
    ]
    return joined.select(*df.columns, *filled)


def _carried(rows: DataFrame, sums: Sequence[str]) -> DataFrame:
    """One row per range: what its first rows continue from the ranges before, and what its last tie
    goes on with in the ranges behind. As many rows as ranges, so one task can window them.

    ``rows`` has the local values of each range: ``__n`` (rows of the key up to the end of the tie),
    ``__rank``, ``__dense`` and the running sums.
    """
    edge = F.struct(
        "__key", "__tie", "__n", "__rank", "__dense", *[F.col(c) for c in sums]
    )
    parts = rows.groupBy(PART).agg(
        F.min_by(edge, INDEX).alias("first"), F.max_by(edge, INDEX).alias("last")
    )
    along = Window.orderBy(PART)
    behind = along.rowsBetween(Window.unboundedPreceding, -1)
    of_key = Window.partitionBy("last.__key").orderBy(PART)
    of_tie = Window.partitionBy("first.__tie").orderBy(F.desc(PART))

    def same_as(a: str, b: str) -> Column:
        return F.coalesce(F.col(a).eqNullSafe(F.col(b)), F.lit(False))

    parts = parts.withColumns({"before": F.lag("last").over(along), "after": F.lead("first").over(along)})
    parts = parts.withColumns(
        {
            "key_on": same_as("first.__key", "before.__key"),
            "tie_on": same_as("first.__tie", "before.__tie"),
            "tie_goes_on": same_as("last.__tie", "after.__tie"),
            "one_key": same_as("first.__key", "last.__key"),
            "one_tie": same_as("first.__tie", "last.__tie"),
        }
    )
    # A tie that goes on from the range before is counted there.
    opened = F.col("last.__dense") - (F.col("one_key") & F.col("tie_on")).cast("int")
    parts = parts.withColumns(
        {
            "run_n": F.sum("last.__n").over(of_key),
            "run_dense": F.sum(opened).over(of_key),
            **{f"run{c}": F.sum(f"last.{c}").over(of_key) for c in sums},
            **{f"rest{c}": F.sum(f"first.{c}").over(of_tie) for c in sums},
        }
    )
    earlier = F.when(F.col("key_on"), F.lag("run_n").over(along)).otherwise(0)
    parts = parts.withColumn("rows_before", earlier)
    # The rank of the tie that is open at a range's end, where the tie starts in that range.
    started = F.when(
        ~(F.col("one_tie") & F.col("tie_on")),
        F.col("last.__rank") + F.when(F.col("one_key"), F.col("rows_before")).otherwise(0),
    )
    parts = parts.withColumn("started", started)
    return parts.select(
        F.col(PART).alias("__at"),
        F.when(F.col("key_on"), F.col("first.__key")).alias("__on_key"),
        F.when(F.col("tie_on"), F.col("first.__tie")).alias("__on_tie"),
        F.when(F.col("tie_goes_on"), F.col("last.__tie")).alias("__open_tie"),
        F.col("rows_before").alias("__rows_before"),
        (F.lag("run_dense").over(along) - F.col("tie_on").cast("int")).alias("__dense_before"),
        F.last("started", ignorenulls=True).over(behind).alias("__tie_rank"),
        *[F.lag(f"run{c}").over(along).alias(f"__before{c}") for c in sums],
        *[F.lead(f"rest{c}").over(along).alias(f"__behind{c}") for c in sums],
    )


def ranked_and_running(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    *,
    sums: Mapping[str, str] | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    row_number: tuple[str, Order] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running sums and rankings per ``by`` along ``order``; ties share rank and sum.

    ``sums`` maps a new column to the column it adds up. ``row_number`` names its column and a total
    order that begins with ``order``, so the numbering is the same on every run. Whether a key has more
    than ``hot_rows`` rows is looked up first; then the table is read once.
    """
    sums = dict(sums or {})
    total = list(row_number[1]) if row_number else list(order)
    if total[: len(order)] != list(order):
        raise ValueError("the order of the row numbers must begin with the order of the ranks")

    def along(keys: Sequence[str]) -> dict[str, Column]:
        keyed = Window.partitionBy(*keys)
        ties = keyed.orderBy(*_sorted(order))
        added = {f"__s{i}": F.sum(c).over(ties) for i, c in enumerate(sums.values())}
        added |= {"__rank": F.rank().over(ties), "__dense": F.dense_rank().over(ties)}
        if row_number:
            added["__row"] = F.row_number().over(keyed.orderBy(*_sorted(total)))
        return added

    names = {"__rank": rank, "__dense": dense_rank, "__row": row_number and row_number[0]}
    names = {**{f"__s{i}": new for i, new in enumerate(sums)}, **{c: n for c, n in names.items() if n}}
    ranked = ("__rank", "__dense", "__row")
    if not has_hot_key(df, by, hot_rows):
        return df.withColumns(
            {names[c]: v.cast("bigint") if c in ranked else v for c, v in along(by).items() if c in names}
        )

    # Where ties have no order of their own, a hash of the whole row spreads a large one over ranges.
    spread = [] if row_number else [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    cut = sorted_ranges(df, [*[F.col(c).asc() for c in by], *_sorted(total), *spread])
    ties = [*by, *[c for c, _ in order]]
    up_to = Window.partitionBy(PART, *by).orderBy(*_sorted(order))
    rows = cut.dealt().withColumns({**along([PART, *by]), "__n": F.count(F.lit(1)).over(up_to)})
    rows = rows.withColumns({"__key": F.struct(*by), "__tie": F.struct(*ties)})
    added = [f"__s{i}" for i in range(len(sums))]
    carried = F.broadcast(_carried(rows, added))  # a row per range
    joined = rows.join(carried, F.col(PART) == F.col("__at"))
    on_key = F.coalesce(F.col("__key") == F.col("__on_key"), F.lit(False))
    on_tie = F.coalesce(F.col("__tie") == F.col("__on_tie"), F.lit(False))
    open_tie = F.coalesce(F.col("__tie") == F.col("__open_tie"), F.lit(False))
    values = {
        "__rank": F.when(on_tie, F.col("__tie_rank")).otherwise(
            F.col("__rank") + F.when(on_key, F.col("__rows_before")).otherwise(0)
        ),
        "__dense": F.col("__dense") + F.when(on_key, F.col("__dense_before")).otherwise(0),
    }
    if row_number:
        values["__row"] = F.col("__row") + F.when(on_key, F.col("__rows_before")).otherwise(0)
    for c in added:
        so_far = _add(F.when(on_key, F.col(f"__before{c}")), F.col(c))
        values[c] = _add(so_far, F.when(open_tie, F.col(f"__behind{c}")))
    kinds = {c: "bigint" if c in ranked else rows.schema[c].dataType for c in values}
    return joined.select(*df.columns, *[values[c].cast(kinds[c]).alias(n) for c, n in names.items()])


def plain_moving(
    df: DataFrame, by: Sequence[str], order: Order, rows: tuple[int, int], aggs: Mapping[str, Column]
) -> DataFrame:
    """The ROWS frame as one window per key, for keys whose rows fit a task."""
    window = Window.partitionBy(*by).orderBy(*_sorted(order)).rowsBetween(*rows)
    return df.withColumns({new: agg.over(window) for new, agg in aggs.items()})


def ranged_moving(
    df: DataFrame, by: Sequence[str], order: Order, rows: tuple[int, int], aggs: Mapping[str, Column]
) -> DataFrame:
    """The ROWS frame per range and key, each range with the neighbours that its frames reach."""
    cut = sorted_ranges(df, [*[F.col(c).asc() for c in by], *_sorted(order)])
    met = cut.dealt(cut.with_guests(max(0, -rows[0]), max(0, rows[1])))
    widened = plain_moving(met, [PART, *by], order, rows, aggs)
    return widened.where(~F.col(GUEST)).select(*df.columns, *aggs)


def moving(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    rows: tuple[int, int],
    aggs: Mapping[str, Column],
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Aggregates over ROWS BETWEEN ``rows[0]`` AND ``rows[1]`` around the current row.

    ``order`` must be total (end in a unique column). Frames reach a few rows: that many rows of each
    range meet in one task.
    """
    way = ranged_moving if has_hot_key(df, by, hot_rows) else plain_moving
    return way(df, by, order, rows, aggs)


def shifted(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    columns: Mapping[str, str],
    offset: int,
    **options,
) -> DataFrame:
    """Values ``offset`` rows away: -1 is the previous row (lag), 1 the next (lead)."""
    aggs = {new: F.first(col) for new, col in columns.items()}
    return moving(df, by, order, (offset, offset), aggs, **options)


def moving_months(
    df: DataFrame,
    by: Sequence[str],
    month: str,
    aggs: Mapping[str, str],
    before: int = 1,
    after: int = 1,
) -> DataFrame:
    """Aggregates over a calendar RANGE of months around each row's month.

    ``df`` holds one row per (by, month), so a group is as long as the calendar, not the data.
    ``aggs`` maps a new column to an aggregate in SQL text: month frames exist only in SQL.
    """
    keys = ", ".join(f"`{c}`" for c in by)
    frame = (
        f"(PARTITION BY {keys} ORDER BY `{month}` RANGE BETWEEN INTERVAL '{before}' MONTH PRECEDING"
        f" AND INTERVAL '{after}' MONTH FOLLOWING)"
    )
    return df.withColumns({new: F.expr(f"{agg} OVER {frame}") for new, agg in aggs.items()})


def running_daily(
    df: DataFrame, by: Sequence[str], ts: str, day: str, aggs: Mapping[str, Column],
    running: Callable[[str], str] = "cumulative_{}".format,
) -> DataFrame:
    """Cumulative metrics: aggregate per (by, day), then the running sum of the daily values.

    After the aggregation a group is as long as the calendar, so one task can window it.
    """
    daily = df.groupBy(*by, F.to_date(ts).alias(day)).agg(
        *[agg.alias(name) for name, agg in aggs.items()]
    )
    window = Window.partitionBy(*by).orderBy(day)
    return daily.withColumns({running(name): F.sum(name).over(window) for name in aggs})


def period_change(df: DataFrame, order: str, value: str, previous: str = "previous") -> DataFrame:
    """Previous period's value next to each row.

    The window has no partition, so it runs as one task: ``df`` must already be one row per
    period (months, say), whose number is set by the calendar and not by the data.
    """
    return df.withColumn(previous, F.lag(value).over(Window.orderBy(order)))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, or any one when rows of a key are all alike.

    The row_number filter becomes a group limit before the shuffle, so a hot key sends one row
    per task; dropDuplicates combines map-side in the same way.
    """
    if order is None:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")
