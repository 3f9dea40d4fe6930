"""The type 2 history of users: bronze rows in, the next stored history and its report out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.operators.quality import Expectation, enforce, evaluate
from sparrowmill.operators.scd2 import empty_history, scd2_apply, scd2_late
from sparrowmill.plans.gold import scd_users_report
from sparrowmill.sources.snapshots import list_snapshots, read_snapshot, write_checked_snapshot

KEY, TRACKED, TS = "id", ("name", "age"), "updated_at"
SNAPSHOT = "history_version"

# The checks of the user history.
HISTORY_SUITE = (
    Expectation("not_null", "id"),
    Expectation("not_null", "start_date"),
    Expectation("matches_strftime", "start_date", {"format": "%Y-%m-%d %H:%M:%S"}),
    Expectation("matches_strftime", "end_date", {"format": "%Y-%m-%d %H:%M:%S"}),
    Expectation("between", "age", {"max_value": 10}),
)


# What must hold before a version is published.
ENFORCED = HISTORY_SUITE[:4]


def as_checked(history: DataFrame) -> DataFrame:
    """The history with its times as the text that the format checks read."""
    return history.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start_date", "end_date")}
    )


def bronze_users(users: DataFrame) -> DataFrame:
    return users.select(KEY, *TRACKED, TS)


def stored_history(spark: SparkSession, path: str, run_ts: str, users: DataFrame) -> DataFrame:
    """The history as it was before this run; empty on the first run."""
    earlier = [s for s in list_snapshots(spark, path, SNAPSHOT) if s < run_ts]
    if not earlier:
        return empty_history(spark, users, KEY, TRACKED, TS)
    return read_snapshot(spark, path, SNAPSHOT, earlier[-1]).drop(SNAPSHOT)


def run_user_history(
    spark: SparkSession, users: DataFrame, path: str, run_ts: str,
    suite: Sequence[Expectation] = ENFORCED,
) -> dict[str, DataFrame]:
    """Apply one snapshot of users and store the result as a new version of the history.

    A rerun with the same time starts from the same earlier version and replaces its own result.
    The rows are checked as written and before any reader sees them: a failing ``suite`` raises
    ``InvalidData``. Returns the report view, the rows too old to apply, and the verdict of each of
    the published checks, whose bound on the age the caller's data may well break.
    """
    users = bronze_users(users)
    before = stored_history(spark, path, run_ts, users)
    write_checked_snapshot(
        scd2_apply(before, users, KEY, TRACKED, TS), path, SNAPSHOT, run_ts,
        lambda written: enforce(as_checked(written), suite, "user history"),
    )
    history = read_snapshot(spark, path, SNAPSHOT, run_ts).drop(SNAPSHOT)
    return {
        "report": scd_users_report(history),
        "late": scd2_late(before, users, KEY, TRACKED, TS),
        "checks": evaluate(as_checked(history), HISTORY_SUITE),
    }
