"""Edge cases the fixture tables cannot show: nulls, ties, empty sides, tolerances."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparrowmill.functions.columns import bucketize, disambiguate
from sparrowmill.functions.exact import charged, mean, scaled
from sparrowmill.operators import aggregates, dml, joins, quality
from sparrowmill.operators.compare import compare_results
from sparrowmill.operators.quality import Expectation, InvalidData
from sparrowmill.operators.stats import profile
from sparrowmill.operators.windows import moving_months, running_daily


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_bucketize_bounds_and_null(spark):
    df = spark.createDataFrame([(None,), (24999.9,), (25000.0,), (100000.0,), (100000.1,)], "p double")
    bands = [("medium", 25_000, 100_000), ("high", 100_000, None)]
    got = [r[0] for r in df.select(bucketize("p", bands, "low")).collect()]
    assert got == ["low", "low", "medium", "medium", "high"]


def test_disambiguate_keeps_keys_and_single_columns(spark):
    left = spark.createDataFrame([(1, "a", 1)], "id int, ts string, x int")
    right = spark.createDataFrame([(1, "b", 2)], "id int, ts string, y int")
    a, b = disambiguate(left, right, ["id"], "l", "r")
    assert a.columns == ["id", "l_ts", "x"] and b.columns == ["id", "r_ts", "y"]
    assert a.join(b, "id").columns == ["id", "l_ts", "x", "r_ts", "y"]


def test_date_functions_golden_values(spark):
    row = spark.range(1).select(
        F.datediff(F.lit("2022-11-05"), F.lit("2022-10-01")),
        F.months_between(F.lit("2022-11-05"), F.lit("2022-10-01")),
        F.months_between(F.lit("2022-11-05"), F.lit("2022-10-01")) / 12,
        F.date_add(F.lit("2022-11-05").cast("date"), 10),
        F.round(F.lit(100.102345), 2), F.abs(F.lit(-100)), F.ceil(F.lit(100.1)), F.floor(F.lit(100.1)),
        F.length(F.lit("hi")), F.trim(F.lit(" hi ")), F.to_date(F.lit("11-05-2023"), "MM-dd-yyyy"),
    ).first()
    assert tuple(row) == (
        35, 1.12903226, 0.09408602166666667, dt.date(2022, 11, 15), 100.1, 100, 101, 100, 2, "hi",
        dt.date(2023, 11, 5),
    )


def test_exact_money(spark):
    df = spark.createDataFrame([(0.1, 0.0, 0.0), (0.2, 0.1, 0.08), (None, 0.0, 0.0)], "p double, d double, t double")
    row = df.agg(
        F.sum(charged("p", "d", "t")).alias("s"),
        mean(F.col("p").cast("decimal(12,2)")).alias("m"),
        scaled(F.sum(F.col("p").cast("decimal(12,2)")), "0.1").alias("r"),
    ).first()
    assert row.s == Decimal("0.294400") and row.m == pytest.approx(0.15) and row.r == Decimal("0.03")


@pytest.mark.parametrize(
    "keys, want",
    [([], [1, 2, None]), ([2], [1]), ([2, None], [])],
    ids=["empty", "plain", "null on the right"],
)
def test_null_aware_anti_is_not_in(spark, keys, want):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(k,) for k in keys], "r int")
    got = joins.anti(left, right, {"k": "r"}, null_aware=True)
    assert rows_of(got) == sorted([(w,) for w in want], key=repr)


def test_semi_and_anti_with_residual(spark):
    left = spark.createDataFrame([(1, 10), (1, 20), (2, 10), (None, 10)], "k int, s int")
    right = spark.createDataFrame([(1, 10), (2, 10)], "rk int, rs int")
    other = F.col("s") != F.col("rs")
    assert rows_of(joins.semi(left, right, {"k": "rk"}, other)) == [(1, 20)]
    assert rows_of(joins.anti(left, right, {"k": "rk"}, other)) == [(1, 10), (2, 10), (None, 10)]
    assert rows_of(joins.anti(left, right, {"k": "rk"})) == [(None, 10)]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        joins.join_with_strategy(spark.range(1), spark.range(1), F.lit(True), strategy="magic")


def test_broadcast_needs_a_small_side(spark, tables):
    from sparrowmill.operators.joins import broadcast_if_small

    assert "broadcast" in broadcast_if_small(tables.nation)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(tables.nation, 1)._jdf.queryExecution().logical().toString()


def test_delete_and_update_leave_unknown_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "i int, s string")
    assert rows_of(dml.delete_where(df, F.col("s") == "a")) == [(2, None), (3, "b")]
    changed = dml.update_where(df, F.col("s") == "a", {"s": F.lit("z"), "i": F.col("i") + 10})
    assert rows_of(changed) == [(11, "z"), (2, None), (3, "b")]
    assert changed.schema == df.schema or changed.schema["i"].dataType == df.schema["i"].dataType


def test_insert_takes_the_target_types(spark):
    target = spark.createDataFrame([], "k bigint, s string")
    more = dml.insert_into(target, spark.createDataFrame([(7, 8)], "x int, y int"))
    assert rows_of(more) == [(7, "8")]
    with pytest.raises(ValueError):
        dml.insert_into(target, spark.range(1))


def test_merge(spark):
    target = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (2, "c", 0), (None, "d", 0)], "k int, n string, a int")
    source = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, n string")
    merged = dml.merge_upsert(
        target, source, ["k"],
        update={"n": F.concat("s_n", F.lit("!")), "a": F.lit(1)},
        insert={"k": F.col("s_k"), "n": F.col("s_n"), "a": F.lit(1)},
    )
    assert rows_of(merged) == sorted(
        [(1, "x!", 1), (1, "x!", 1), (2, "c", 0), (None, "d", 0), (3, "y", 1), (None, "z", 1)], key=repr
    )
    with pytest.raises(Exception, match="merge source"):
        dml.merge_upsert(target, source.unionAll(source), ["k"], {}, {}).collect()


def test_refresh(spark):
    orders = spark.createDataFrame([(1,), (2,)], "o_orderkey int")
    lines = spark.createDataFrame([(1,), (1,), (2,)], "l_orderkey int")
    o, l = dml.apply_refresh(
        orders, lines, spark.createDataFrame([(3,)], "o_orderkey int"),
        spark.createDataFrame([(3,), (3,)], "l_orderkey int"), spark.createDataFrame([(1,), (1,)], "k int"),
    )
    assert rows_of(o) == [(2,), (3,)] and rows_of(l) == [(2,), (3,), (3,)]


def test_evolve(spark):
    df = dml.evolve(spark.createDataFrame([(1, "c")], "i int, c string"), {"p": "string"}, ["c"])
    assert df.columns == ["i", "p"] and rows_of(df) == [(1, None)]


def test_grouping_sets_and_pivot(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4), ("b", "x", 8)], "g string, c string, v int")
    sets = aggregates.grouping_sets(df, [["g"], ["c"]], {"s": F.sum("v")}, value="v")
    assert rows_of(sets) == sorted([("a", None, 3), ("b", None, 12), (None, "x", 13), (None, "y", 2)], key=repr)
    pivot = aggregates.pivot_table(df, ["g"], "c", {"x": "ex", "y": "why", "q": "none"}, F.sum("v"))
    assert pivot.columns == ["g", "ex", "why", "none"]
    assert rows_of(pivot) == [("a", 1, 2, None), ("b", 12, None, None)]


def test_month_range_frame_skips_gaps(spark):
    df = spark.createDataFrame([("c", "2024-01-01", 1), ("c", "2024-02-01", 2), ("c", "2024-05-01", 4)], "k string, m string, v int")
    got = moving_months(df.withColumn("m", F.col("m").cast("date")), ["k"], "m", {"s": "sum(v)"})
    assert [r.s for r in got.orderBy("m").collect()] == [3, 3, 4]


def test_running_daily(spark):
    df = spark.createDataFrame([("c", "2024-01-02 10:00:00", 1), ("c", "2024-01-02 11:00:00", 2), ("c", "2024-01-05 00:00:00", 4)], "k string, t string, v int")
    got = running_daily(df.withColumn("t", F.col("t").cast("timestamp")), ["k"], "t", "day", {"v": F.sum("v")})
    assert [(r.v, r.cumulative_v) for r in got.orderBy("day").collect()] == [(3, 3), (4, 7)]


def test_expectations(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 5), (1, "nonsense", 11), (2, None, None), (None, "2024-01-01 00:00:00", 10)],
        "id int, ts string, age int",
    )
    suite = [
        Expectation("unique", "id"), Expectation("not_null", "id"),
        Expectation("matches_strftime", "ts", {"format": "%Y-%m-%d %H:%M:%S"}),
        Expectation("between", "age", {"max_value": 10}),
        Expectation("max_between", "age", {"min_value": 0, "max_value": 11, "strict_max": True}),
        Expectation("max_between", "age", {"min_value": 0, "max_value": 11}),
    ]
    report = {r["position"]: (r["unexpected"], r["success"]) for r in quality.evaluate(df, suite).collect()}
    assert report == {0: (2, False), 1: (1, False), 2: (1, False), 3: (1, False), 4: (1, False), 5: (0, True)}
    with pytest.raises(InvalidData, match="unique"):
        quality.enforce(df, suite, "people")
    quality.enforce(df, suite[-1:], "people")
    with pytest.raises(ValueError):
        Expectation("odd", "id")


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 2)], "a int, b int")
    assert rows_of(quality.pk_violations(df, ["a", "b"])) == [(1, 1, 2)]
    parent = spark.createDataFrame([(2,)], "p int")
    assert rows_of(quality.fk_violations(df, parent, ["a"], ["p"])) == [(1, 3)]


def test_compare_results_tolerances(spark):
    schema = "k int, s string, n double, t double, a double, r double, c bigint"
    actual = spark.createDataFrame([(1, "x ", 1.001, 1000.0, 100.0, 5.0, 3), (2, "x", 1.0, 0.0, 0.0, 0.0, 1), (4, None, None, None, None, None, None)], schema)
    expected = spark.createDataFrame([(1, "x", 1.004, 1100.0, 101.0, 6.0, 3), (3, "x", 1.0, 0.0, 0.0, 0.0, 1), (4, None, None, None, None, None, None)], schema)
    precision = {"s": "str", "n": "num", "t": "sum", "a": "avg", "r": "rat", "c": "cnt"}
    found = rows_of(compare_results(actual, expected, ["k"], precision).select("k", "column"))
    assert found == [(2, "(row)"), (3, "(row)")]
    worse = expected.withColumns({c: F.col(c) + 101 for c in ("t", "a", "r", "c")})
    found = {r["column"] for r in compare_results(actual, worse, ["k"], precision).filter("k = 1").collect()}
    assert found == {"t", "a", "r", "c"}


def test_profile_estimates_and_exact_counts(spark):
    df = spark.createDataFrame([(1, "aa"), (2, None), (2, "b")], "i int, s string")
    for exact in (False, True):
        got = {r["column"]: r for r in profile(df, exact_distinct=exact).collect()}
        assert (got["i"]["rows"], got["i"]["nulls"], got["i"]["distinct_values"]) == (3, 0, 2)
        assert (got["s"]["nulls"], got["s"]["min_value"], got["s"]["max_length"]) == (1, "aa", 2)
        assert got["s"]["avg_length"] == 1.5


def test_format_letters_and_empty_maximum(spark):
    from sparrowmill.operators.quality import Expectation, date_pattern, evaluate

    assert date_pattern("%Y-%m-%dT%H:%M") == "yyyy'-'MM'-'dd'T'HH':'mm"
    with pytest.raises(ValueError, match="%q"):
        Expectation("matches_strftime", "s", {"format": "%q"})
    df = spark.createDataFrame([("2024-01-02T03:04",), ("2024-01-02 03:04",)], "s string")
    row = evaluate(df, [Expectation("matches_strftime", "s", {"format": "%Y-%m-%dT%H:%M"})]).head()
    assert row["unexpected"] == 1
    empty = evaluate(df.limit(0), [Expectation("max_between", "s", {"max_value": "z"})]).head()
    assert not empty["success"]


def test_merge_inserts_every_null_key(spark):
    target = spark.createDataFrame([(1, "a"), (None, "t")], "k int, v string")
    source = spark.createDataFrame([(1, "A"), (None, "x"), (None, "y")], "k int, v string")
    new = {"k": F.col("s_k"), "v": F.col("s_v")}
    got = dml.merge_upsert(target, source, ["k"], {"v": F.col("s_v")}, new).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "A"), (None, "t"), (None, "x"), (None, "y")], key=repr)

