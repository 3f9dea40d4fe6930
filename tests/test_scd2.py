"""Type 2 history: single steps, nulls, late rows, and the two roads to the same history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import scd2

SNAPSHOT = "id int, name string, age int, updated_at string"
ARGS = ("id", ["name", "age"], "updated_at")


def snap(spark, *rows):
    return spark.createDataFrame(list(rows), SNAPSHOT).withColumn(
        "updated_at", F.col("updated_at").cast("timestamp")
    )


def shown(df):
    text = [F.date_format(c, "dd").alias(c) for c in ("start_date", "end_date")]
    return sorted(
        map(tuple, df.select("id", "name", "age", *text, "is_active").collect()), key=repr
    )


def day(n):
    return f"2024-01-{n:02d} 00:00:00"


@pytest.fixture(scope="module")
def first(spark):
    rows = snap(spark, (1, "a", 1, day(1)), (2, "b", None, day(1)), (3, "c", 3, day(1)), (4, "d", 4, day(5)))
    return scd2.scd2_apply(scd2.empty_history(spark, rows, *ARGS), rows, *ARGS)


def test_initial_load_is_one_active_row_each(first):
    assert all(r[-1] and r[4] is None for r in shown(first)) and first.count() == 4


def test_changes_nulls_late_and_missing(spark, first):
    second = snap(
        spark,
        (1, "a", 2, day(9)),     # changed
        (2, "b", None, day(9)),  # null stays null: no change
        (3, None, 3, day(9)),    # a value becomes null
        (4, "x", 4, day(2)),     # older than the active version
        (5, "e", 5, day(9)),     # new
    )
    assert shown(scd2.scd2_changes(first, second, *ARGS)) == sorted(
        [(1, "a", 2, "09", None, True), (3, None, 3, "09", None, True), (5, "e", 5, "09", None, True)], key=repr
    )
    assert shown(scd2.scd2_closed(first, second, *ARGS)) == [
        (1, "a", 1, "01", "09", False), (3, "c", 3, "01", "09", False)
    ]
    late = scd2.scd2_late(first, second, *ARGS).collect()
    assert [(r.id, r.name) for r in late] == [(4, "x")]
    after = scd2.scd2_apply(first, second, *ARGS)
    assert shown(after) == sorted(
        [
            (1, "a", 1, "01", "09", False), (1, "a", 2, "09", None, True),
            (2, "b", None, "01", None, True),
            (3, "c", 3, "01", "09", False), (3, None, 3, "09", None, True),
            (4, "d", 4, "05", None, True), (5, "e", 5, "09", None, True),
        ],
        key=repr,
    )
    assert shown(scd2.scd2_apply(after, second, *ARGS)) == shown(after)
    third = snap(spark, (1, "a", 3, day(20)))
    closed = {r[3:5] for r in shown(scd2.scd2_apply(after, third, *ARGS)) if r[0] == 1}
    assert closed == {("01", "09"), ("09", "20"), ("20", None)}


def test_missing_keys_close_only_on_request(spark, first):
    rows = snap(spark, (1, "a", 1, day(9)))
    assert shown(scd2.scd2_apply(first, rows, *ARGS)) == shown(first)
    when = F.lit(day(9)).cast("timestamp")
    closed = scd2.scd2_apply(first, rows, *ARGS, close_missing=when)
    assert [r[0] for r in shown(closed) if r[-1]] == [1]
    assert shown(scd2.scd2_closed(first, rows, *ARGS, close_missing=when)) == [
        r for r in shown(closed) if not r[-1]
    ]


def test_repeated_keys_are_refused(spark, first):
    rows = snap(spark, (1, "a", 5, day(9)), (1, "a", 6, day(10)))
    with pytest.raises(Exception, match="occurs more than once"):
        scd2.scd2_apply(first, rows, *ARGS).collect()


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_one_pass_equals_step_by_step(spark, hot_rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(hot_rows > 3))  # a range per partition
    rng = random.Random(11)
    names, ages = ["a", "b", None], [1, 2, None]
    log = [
        (i, rng.choice(names), rng.choice(ages), day(d))
        for d in range(1, 9) for i in range(1, 13) if i == 1 or rng.random() < 0.6
    ]
    frame = snap(spark, *log)
    history = scd2.empty_history(spark, frame, *ARGS)
    for d in range(1, 9):
        rows = [r for r in log if r[3] == day(d)]
        history = scd2.scd2_apply(history, snap(spark, *rows), *ARGS)
        # Bring the growing plan back to plain rows between steps, as a stored table would.
        history = spark.createDataFrame(history.collect(), history.schema)
    one_pass = scd2.scd2_from_log(frame, *ARGS, hot_rows=hot_rows)
    assert shown(one_pass) == shown(history)
    broken = {r.rule: r.violations for r in scd2.scd2_violations(one_pass, "id", hot_rows=hot_rows).collect()}
    assert broken == dict.fromkeys(
        ["active_with_end_date", "closed_without_end_date", "several_active", "overlapping"], 0
    )
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_user_is_cut_into_ranges(spark):
    """One user with most of the log, repeated values and a version that starts ranges later."""
    rng = random.Random(12)
    log = [(1, "a" if d < 150 else rng.choice("ab"), 1, f"2024-01-01 00:{d // 60:02d}:{d % 60:02d}") for d in range(240)]
    log += [(i, rng.choice("ab"), None, day(d)) for i in range(2, 20) for d in range(1, 5)]
    frame = snap(spark, *log).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = scd2.scd2_from_log(frame, *ARGS, hot_rows=50)
        assert "__part" in cut._jdf.queryExecution().analyzed().toString()
        plain = scd2.scd2_from_log(frame, *ARGS)
        rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
        assert rows(cut) == rows(plain)
        assert rows(scd2.scd2_violations(cut, "id", hot_rows=50)) == rows(scd2.scd2_violations(plain, "id"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_violations_are_found(spark):
    rows = [(1, day(1), None, True), (1, day(2), None, True), (2, day(1), day(3), True), (2, day(2), None, False)]
    history = spark.createDataFrame(rows, "id int, start_date string, end_date string, is_active boolean")
    history = history.withColumns({c: F.col(c).cast("timestamp") for c in ("start_date", "end_date")})
    got = {r.rule: r.violations for r in scd2.scd2_violations(history, "id").collect()}
    assert got == {
        "active_with_end_date": 1, "closed_without_end_date": 1, "several_active": 1, "overlapping": 2
    }


def test_null_times_and_null_keys_lose_no_row(spark):
    when = dt.datetime(2024, 1, 1)
    history = spark.createDataFrame(
        [(1, "a", None, None, True), (2, "b", None, None, True), (3, "c", when, None, True), (None, "d", when, None, True)],
        "id int, name string, start_date timestamp, end_date timestamp, is_active boolean",
    )
    later = dt.datetime(2024, 2, 1)
    snapshot = spark.createDataFrame(
        [(2, "B", later), (3, "C", None), (None, "D", later)], "id int, name string, updated_at timestamp"
    )
    got = {tuple(r) for r in scd2.scd2_apply(history, snapshot, "id", ["name"], "updated_at").collect()}
    assert got == {
        (1, "a", None, None, True), (2, "b", None, later, False), (2, "B", later, None, True),
        (3, "c", when, None, True), (None, "d", when, later, False), (None, "D", later, None, True),
    }
    late = scd2.scd2_late(history, snapshot, "id", ["name"], "updated_at").collect()
    assert [tuple(r) for r in late] == [(3, "C", None)]


def test_repeated_log_rows_and_two_active_versions_fail(spark):
    when = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(1, "a", when), (1, "b", when)], "id int, name string, updated_at timestamp")
    with pytest.raises(Exception, match="change log"):
        scd2.scd2_from_log(log, "id", ["name"], "updated_at").collect()
    history = spark.createDataFrame(
        [(1, "a", when, None, True), (1, "b", when, None, True)],
        "id int, name string, start_date timestamp, end_date timestamp, is_active boolean",
    )
    with pytest.raises(Exception, match="active history"):
        scd2.scd2_apply(history, log.limit(0), "id", ["name"], "updated_at").collect()
