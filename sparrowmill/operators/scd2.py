"""Slowly changing dimension, type 2: history rows with start_date, end_date and is_active."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.operators.ranges import GUEST, PART, sorted_ranges
from sparrowmill.operators.skew import HOT_ROWS, assert_unique, has_hot_key, occurs_again
from sparrowmill.operators.windows import shifted


def history_schema(snapshot: DataFrame, key: str, tracked: Sequence[str], ts: str) -> T.StructType:
    fields = [T.StructField(c, snapshot.schema[c].dataType) for c in [key, *tracked]]
    when = snapshot.schema[ts].dataType
    return T.StructType(
        [
            *fields,
            T.StructField("start_date", when),
            T.StructField("end_date", when),
            T.StructField("is_active", T.BooleanType()),
        ]
    )


def empty_history(
    spark: SparkSession, snapshot: DataFrame, key: str, tracked: Sequence[str], ts: str
) -> DataFrame:
    return spark.createDataFrame([], history_schema(snapshot, key, tracked, ts))


def _differs(tracked: Sequence[str], prefix: str) -> Column:
    """Some tracked column changed; null equals null."""
    return ~reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in tracked]
    )


def _pair(history: DataFrame, snapshot: DataFrame, key: str, tracked, ts) -> DataFrame:
    """Active versions next to incoming rows. Both sides hold one row per key, which is checked.

    ``n_has`` and ``o_has`` mark the sides a row comes from. A null key is a key like any other.
    """
    active = assert_unique(history.filter("is_active"), [key], "active history")
    active = active.withColumn("o_has", F.lit(True))
    incoming = assert_unique(snapshot.select(key, *tracked, ts), [key], "snapshot").select(
        F.col(key).alias("n_key"),
        *[F.col(c).alias(f"n_{c}") for c in tracked],
        F.col(ts).alias("n_ts"),
        F.lit(True).alias("n_has"),
    )
    return active.join(incoming, F.col(key).eqNullSafe(F.col("n_key")), "full")


def _is_late() -> Column:
    """Not known to be newer: a row without a time is late beside any version."""
    return ~F.coalesce(F.col("n_ts") > F.col("start_date"), F.col("n_ts").isNotNull())


def _is_change(tracked: Sequence[str]) -> Column:
    return F.col("n_has").isNotNull() & (
        F.col("o_has").isNull() | (_differs(tracked, "n_") & ~_is_late())
    )


def scd2_changes(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], ts: str
) -> DataFrame:
    """New versions: incoming rows that differ from the active version or have none."""
    return (
        _pair(history, snapshot, key, tracked, ts)
        .filter(_is_change(tracked))
        .select(
            F.col("n_key").alias(key),
            *[F.col(f"n_{c}").alias(c) for c in tracked],
            F.col("n_ts").alias("start_date"),
            F.lit(None).cast(history.schema["end_date"].dataType).alias("end_date"),
            F.lit(True).alias("is_active"),
        )
    )


def scd2_late(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], ts: str
) -> DataFrame:
    """Changed rows no newer than the active version: not applied, handed back to the caller."""
    return (
        _pair(history, snapshot, key, tracked, ts)
        .filter("n_has IS NOT NULL AND o_has IS NOT NULL")
        .filter(_differs(tracked, "n_") & _is_late())
        .select(
            F.col("n_key").alias(key),
            *[F.col(f"n_{c}").alias(c) for c in tracked],
            F.col("n_ts").alias(ts),
        )
    )


def scd2_closed(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str,
    close_missing: Column | None = None,
) -> DataFrame:
    """The active versions that end now, with end_date set to the start of their successor.

    With ``close_missing`` (a time) versions whose key left the source end then.
    """
    pair = _pair(history, snapshot, key, tracked, ts).filter(F.col("o_has").isNotNull())
    replaced = F.coalesce(_is_change(tracked), F.lit(False))
    end = F.when(replaced, F.col("n_ts"))
    if close_missing is not None:
        end = end.when(F.col("n_has").isNull(), close_missing)
    end = end.cast(history.schema["end_date"].dataType)
    return (
        pair.withColumn("end_date", end)
        .filter(F.col("end_date").isNotNull())
        .withColumn("is_active", F.lit(False))
        .select(*history.columns)
    )


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str,
    close_missing: Column | None = None,
) -> DataFrame:
    """The next history: past versions, active versions kept or closed, and new versions.

    Past versions pass through without a join, so a key with a very long history costs nothing.
    Only active versions meet the snapshot, one row per key on each side, in a single join whose
    rows fan out to at most two versions. Applying the same snapshot again changes nothing.
    """
    end_type = history.schema["end_date"].dataType
    change = F.coalesce(_is_change(tracked), F.lit(False))
    end = F.when(change, F.col("n_ts"))
    if close_missing is not None:
        end = end.when(F.col("n_has").isNull(), close_missing)
    end = end.cast(end_type)
    stored = F.when(
        F.col("o_has").isNotNull(),
        F.struct(
            F.col(key),
            *[F.col(c) for c in tracked],
            F.col("start_date"),
            end.alias("end_date"),
            end.isNull().alias("is_active"),
        ),
    )
    added = F.when(
        change,
        F.struct(
            F.col("n_key").alias(key),
            *[F.col(f"n_{c}").alias(c) for c in tracked],
            F.col("n_ts").alias("start_date"),
            F.lit(None).cast(end_type).alias("end_date"),
            F.lit(True).alias("is_active"),
        ),
    )
    moved = (
        _pair(history, snapshot, key, tracked, ts)
        .select(F.explode(F.array_compact(F.array(stored, added))).alias("v"))
        .select("v.*")
    )
    past = history.filter(~F.coalesce(F.col("is_active"), F.lit(False)))
    return past.unionByName(moved)


def scd2_from_log(
    log: DataFrame, key: str, tracked: Sequence[str], ts: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The whole history in one pass over a change log, one row per (key, time), which is checked.

    Rows that repeat the version before them are dropped, then each version ends where the next one
    starts. Both look at one neighbour in the same sort, which also shows a (key, time) that occurs
    twice. Where a key has more than ``hot_rows`` rows, the log is sorted in ranges by key and time
    instead: each range gets the row before its first one, and the start of the next version behind it.
    """
    rows = log.select(F.col(key), *[F.col(c) for c in tracked], F.col(ts).alias("start_date"))
    hot = has_hot_key(rows, [key], hot_rows)
    frame, by = rows.withColumn(GUEST, F.lit(False)), [key]
    if hot:
        cut = sorted_ranges(rows, [F.col(key).asc(), F.col("start_date").asc()])
        frame, by = cut.dealt(cut.with_guests(1, 0)), [PART, key]
    along = Window.partitionBy(*by).orderBy("start_date")
    beside = frame.withColumns(
        {"p_has": F.lag(F.lit(True)).over(along), "p_start": F.lag("start_date").over(along),
         **{f"p_{c}": F.lag(c).over(along) for c in tracked}}
    )
    twice = F.col("p_has").isNotNull() & F.col("start_date").eqNullSafe(F.col("p_start"))
    again = occurs_again("change log", [key, "start_date"]).cast("boolean")
    changed = F.col("p_start").isNull() | _differs(tracked, "p_")
    kept = beside.filter(F.when(twice, again).otherwise(~F.col(GUEST) & changed))
    end = F.lead("start_date").over(along)
    if hot:
        version = F.struct(F.col(key).alias("key"), F.col("start_date").alias("start"))
        behind = Window.orderBy(PART).rowsBetween(1, Window.unboundedFollowing)
        later = kept.groupBy(PART).agg(F.min(version).alias("least")).select(
            F.col(PART).alias("__at"), F.first("least").over(behind).alias("next")
        )
        kept = kept.join(F.broadcast(later), F.col(PART) == F.col("__at"))  # a row per range
        goes_on = F.col("next.key").eqNullSafe(F.col(key))
        end = F.coalesce(end, F.when(goes_on, F.col("next.start")))
    return kept.withColumn("end_date", end).select(
        *rows.columns, "end_date", F.col("end_date").isNull().alias("is_active")
    )


def scd2_violations(history: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per rule with the number of rows (or keys) that break it."""
    ordered = shifted(
        history.select(key, "start_date", "end_date", "is_active"),
        [key],
        [("start_date", "asc")],
        {"next_start": "start_date"},
        1,
        hot_rows=hot_rows,
    )
    ended = F.col("end_date").isNotNull()
    rows = ordered.agg(
        F.count_if(F.col("is_active") & ended).alias("active_with_end_date"),
        F.count_if(~F.col("is_active") & ~ended).alias("closed_without_end_date"),
        F.count_if(
            F.col("next_start").isNotNull()
            & (~ended | (F.col("end_date") > F.col("next_start")))
        ).alias("overlapping"),
    )
    several = (
        history.filter("is_active")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("several_active"))
    )

    def as_rows(wide: DataFrame) -> DataFrame:
        pairs = [
            F.struct(F.lit(c).alias("rule"), F.col(c).cast("long").alias("violations"))
            for c in wide.columns
        ]
        return wide.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")

    return as_rows(rows).unionByName(as_rows(several))
