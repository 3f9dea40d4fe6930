"""Join operators: strategies, date bands, semi and anti joins, and joins counted without pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.operators.skew import apart
from sparrowmill.operators.windows import cumulative

STRATEGIES = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")
BROADCAST_LIMIT = 64 << 20


def _equal(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in on.items()])


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: file metadata and statistics, no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def goes_to_all_tasks(df: DataFrame) -> bool:
    """Whether Catalyst would broadcast it in a join, by the estimate and the session's threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= threshold


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only below ``limit`` bytes; beyond it the planner picks a shuffle join."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def join_with_strategy(
    left: DataFrame, right: DataFrame, on: Column, how: str = "inner", strategy: str | None = None
) -> DataFrame:
    """Join with a chosen physical strategy for the right side.

    Broadcast is size-checked. Nested loops read the right side once per left partition, so they
    too need a small right side. A named strategy is never swapped for another: too large a right
    side raises.
    """
    if strategy is None:
        return left.join(right, on, how)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy in ("broadcast", "shuffle_replicate_nl") and estimated_bytes(right) > BROADCAST_LIMIT:
        raise ValueError(f"{strategy} needs a right side of at most {BROADCAST_LIMIT} bytes")
    return left.join(right.hint(strategy), on, how)


def semi(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], residual: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """EXISTS / IN. Without a residual only the right side's distinct keys travel, so neither a
    key that is hot on the left nor one that is hot on the right fills a task. ``unique`` says that
    the right side holds each key once already.
    """
    if residual is None:
        right = right.select(*on.values())
        right = apart(right if unique else right.distinct())
        return left.join(right, _equal(left, right, on), "left_semi")
    return left.join(right, _equal(left, right, on) & residual, "left_semi")


def anti(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    residual: Column | None = None,
    null_aware: bool = False,
) -> DataFrame:
    """NOT EXISTS, or NOT IN with ``null_aware`` (one key, no residual).

    NOT IN keeps no row when the right side holds a null, keeps every row when the right side is
    empty, and otherwise never keeps a left row whose key is null.
    """
    if null_aware:
        if residual is not None or len(on) != 1:
            raise ValueError("null-aware anti join takes one key and no residual")
        ((left_key, right_key),) = on.items()
        state = right.agg(
            F.when(F.count(F.lit(1)) == 0, "empty")
            .when(F.count_if(F.col(right_key).isNull()) > 0, "nulls")
            .otherwise("keys")
        ).scalar()
        kept = anti(left, right, on)
        return kept.filter((state == "empty") | ((state == "keys") & F.col(left_key).isNotNull()))
    if residual is None:
        right = apart(right.select(*on.values()).distinct())
        return left.join(right, _equal(left, right, on), "left_anti")
    return left.join(right, _equal(left, right, on) & residual, "left_anti")


def _within(left_ts: Column, right_ts: Column, days: int) -> Column:
    span = F.make_dt_interval(days=F.lit(days))
    return left_ts.between(right_ts - span, right_ts + span)


def band_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    left_ts: str,
    right_ts: str,
    days: int,
    how: str = "inner",
) -> DataFrame:
    """Equi join with the two times at most ``days`` apart; how is inner, left, right, full or
    left_anti.

    The outer forms are the inner join plus the unmatched rows. An inner join can be split on
    either side when a key is hot, an outer join only on one, and the unmatched side needs just
    the distinct (key, time) pairs of the other.
    """

    def unmatched(side: DataFrame, other: DataFrame, keys: Mapping[str, str], ts, other_ts):
        probes = other.select(*keys.values(), other_ts).distinct()
        hit = _equal(side, probes, keys) & _within(side[ts], probes[other_ts], days)
        return side.join(probes, hit, "left_anti")

    if how == "left_anti":
        return unmatched(left, right, on, left_ts, right_ts)
    near = _equal(left, right, on) & _within(left[left_ts], right[right_ts], days)
    joined = left.join(right, near, "inner")
    if how in ("left", "full"):
        alone = unmatched(left, right, on, left_ts, right_ts)
        joined = joined.unionByName(alone, allowMissingColumns=True)
    if how in ("right", "full"):
        back = {b: a for a, b in on.items()}
        alone = unmatched(right, left, back, right_ts, left_ts)
        joined = joined.unionByName(alone, allowMissingColumns=True)
    return joined


def band_join_counts(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    left_ts: str,
    right_ts: str,
    days: int,
    how: str,
    names: tuple[str, str],
) -> DataFrame:
    """Both sides' non-null row counts of ``band_join``, from weights instead of joined rows.

    Each side shrinks to one row per (key, time) with its row count before the shuffle. Where the
    times are dates a key then has no more rows than the calendar has days, and one outer join
    does; with finer times the outer forms are composed as in ``band_join``.
    """

    def weigh(df: DataFrame, keys: Sequence[str], ts: str, name: str) -> DataFrame:
        return df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias(name))

    lefts = weigh(left, list(on), left_ts, "__n_left")
    rights = weigh(right, list(on.values()), right_ts, "__n_right")
    if all(isinstance(df.schema[c].dataType, T.DateType) for df, c in ((left, left_ts), (right, right_ts))):
        near = _equal(lefts, rights, on) & _within(lefts[left_ts], rights[right_ts], days)
        joined = lefts.join(rights, near, how)
    else:
        joined = band_join(lefts, rights, on, left_ts, right_ts, days, how)
    pairs = F.coalesce(F.col("__n_left"), F.lit(1)) * F.coalesce(F.col("__n_right"), F.lit(1))

    def counted(weight: str, key: str) -> Column:
        seen = F.col(weight).isNotNull() & F.col(key).isNotNull()
        return F.coalesce(F.sum(F.when(seen, pairs)), F.lit(0))

    return joined.agg(
        counted("__n_left", next(iter(on))).alias(names[0]),
        counted("__n_right", next(iter(on.values()))).alias(names[1]),
    )


def self_pair_counts(
    df: DataFrame, group: Mapping[str, Column], identity: str, name: str = "pair_rows"
) -> DataFrame:
    """How many ordered pairs of different ``identity`` each group would give in a self join.

    n rows make n * n pairs less those within one identity, so no pair is ever built. Rows with a
    null in the group or the identity match nothing, as in the join.
    """
    keyed = df.select(*[c.alias(k) for k, c in group.items()], F.col(identity))
    for key in [*group, identity]:
        keyed = keyed.filter(F.col(key).isNotNull())
    copies = keyed.groupBy(*group, identity).agg(F.count(F.lit(1)).alias("__m"))
    return (
        copies.groupBy(*group)
        .agg(F.sum("__m").alias("__n"), F.sum(F.col("__m") * F.col("__m")).alias("__same"))
        .withColumn(name, F.col("__n") * F.col("__n") - F.col("__same"))
        .filter(F.col(name) > 0)
        .drop("__n", "__same")
    )


def totals_at_or_above(
    facts: DataFrame,
    key: str,
    points: DataFrame,
    point: str,
    totals: Mapping[str, Column],
    width: int,
) -> DataFrame:
    """For each point row, aggregates over the facts with ``key >= point``: a >= join, summed.

    Joining would build about facts x points / 2 rows. Here the facts shrink to one row per key,
    and the points read off a running sum from the highest key down, cut into bands of ``width``.
    """
    summed = facts.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__at")).agg(
        *[agg.alias(new) for new, agg in totals.items()]
    )
    marks = points.filter(F.col(point).isNotNull()).select(F.col(point).alias("__at")).distinct()
    timeline = (
        summed.unionByName(marks, allowMissingColumns=True)
        .groupBy("__at")
        .agg(*[F.sum(new).alias(new) for new in totals])
    )
    running = cumulative(
        timeline,
        [],
        [("__at", "desc")],
        [(F.floor(F.col("__at") / F.lit(width)), "desc")],
        {f"__run_{new}": new for new in totals},
    )
    reached = running.select("__at", *[F.col(f"__run_{new}").alias(new) for new in totals]).filter(
        reduce(lambda a, b: a | b, [F.col(new).isNotNull() for new in totals])
    )
    return points.join(reached, points[point] == reached["__at"], "inner").drop("__at")
