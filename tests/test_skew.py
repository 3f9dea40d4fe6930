"""Hot keys: the split road must give what the plain operator gives, nulls and ties included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.operators import joins, ranges, sets, skew, windows

HOT = 50


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 1 holds a third of the rows, and so does the null key; values tie often."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = 1 if i % 3 == 0 else None if i % 3 == 1 else rng.randint(2, 60)
        value = None if rng.random() < 0.05 else rng.randint(0, 40)
        rows.append((key, value, rng.choice([None, 1, 2, 3, 4]), i))
    df = spark.createDataFrame(rows, "k bigint, v bigint, x bigint, id bigint")
    return df.repartition(6)


@pytest.fixture
def many_ranges(spark):
    """Every shuffle partition is a range of its own, however few rows it has."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_hot_keys_are_seen(skewed):
    assert {r[0] for r in skew.hot_keys(skewed, ["k"], HOT).collect()} == {1, None}
    assert skew.has_hot_key(skewed, ["k"], HOT) and not skew.has_hot_key(skewed, ["k"], 900)
    assert not skew.has_hot_key(skewed.filter("k > 1"), ["k"], HOT)


def test_hot_keys_in_crowds(skewed):
    found = skew.hot_keys_in_crowds(skewed, ["k"], HOT)
    assert {r[0] for r in found.collect()} == {1, None}
    assert skew.hot_keys_in_crowds(skewed, ["k"], 900) is None
    # Hashes that many keys share are hot where no key is.
    assert skew.hot_keys_in_crowds(skewed.filter("k > 1"), ["k"], HOT) is None
    assert skew.hot_keys_in_crowds(skewed.filter("k > 1").select("id"), ["id"], 1) is None


def test_ranges_and_their_guests(skewed, many_ranges):
    cut = ranges.sorted_ranges(skewed, [F.col("k").asc(), F.col("id").asc()])
    rows = sorted(cut.rows.collect(), key=lambda r: (r["__part"], r["__index"]))
    assert [r["id"] for r in rows] == [r["id"] for r in skewed.orderBy("k", "id").collect()]
    assert len(cut.lengths) == rows[-1]["__part"] + 1 > 4 and sum(cut.lengths) == len(rows)
    for back, ahead in ((1, 0), (0, 2), (3, 3), (400, 1)):  # further than a range is long
        met = cut.with_guests(back, ahead).collect()
        for part in {r["__part"] for r in rows}:
            here = [i for i, r in enumerate(rows) if r["__part"] == part]
            want = {*range(max(0, here[0] - back), here[0]), *range(here[-1] + 1, here[-1] + ahead + 1)}
            guests = {r["id"] for r in met if r["__part"] == part and r["__guest"]}
            assert guests == {rows[i]["id"] for i in want if i < len(rows)}
        assert sum(not r["__guest"] for r in met) == len(rows)


@pytest.mark.parametrize("way", ["asc", "desc"])
def test_rankings_and_running_sums(skewed, many_ranges, way):
    total = [("v", way), ("id", "asc")]
    split = windows.ranked_and_running(
        skewed, ["k"], [("v", way)], sums={"run": "x"}, rank="r", dense_rank="d",
        row_number=("n", total), hot_rows=HOT,
    )
    order = F.col("v").asc() if way == "asc" else F.col("v").desc()
    w = Window.partitionBy("k").orderBy(order)
    plain = (
        skewed.withColumn("run", F.sum("x").over(w))
        .withColumn("r", F.rank().over(w))
        .withColumn("d", F.dense_rank().over(w))
        .withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(order, "id")))
    )
    columns = ["id", "run", "r", "d", "n"]
    assert rows_of(split, *columns) == rows_of(plain, *columns)
    assert split.schema["r"].dataType == T.LongType()  # a hot key may have more rows than an int


@pytest.mark.parametrize("values", [1, 2, 5])
def test_ties_that_fill_whole_ranges(spark, many_ranges, values):
    """One key and few values: ties start, go on through and end in ranges of other keys' rows."""
    rows = [(i // 400, i * 7 % 400 // (400 // values + 1), i % 5 or None, i) for i in range(1200)]
    df = spark.createDataFrame(rows, "k int, v int, x int, id int").repartition(5)
    split = windows.ranked_and_running(
        df, ["k"], [("v", "desc")], sums={"run": "x"}, rank="r", dense_rank="d", hot_rows=100
    )
    w = Window.partitionBy("k").orderBy(F.desc("v"))
    plain = df.withColumns({"run": F.sum("x").over(w), "r": F.rank().over(w), "d": F.dense_rank().over(w)})
    assert rows_of(split, "id", "run", "r", "d") == rows_of(plain, "id", "run", "r", "d")
    numbered = windows.ranked_and_running(
        df, ["k"], [("v", "desc")], rank="r", dense_rank="d", hot_rows=100,
        row_number=("n", [("v", "desc"), ("id", "asc")]),
    )
    plain = plain.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "id")))
    assert rows_of(numbered, "id", "r", "d", "n") == rows_of(plain, "id", "r", "d", "n")
    with pytest.raises(ValueError):
        windows.ranked_and_running(df, ["k"], [("v", "desc")], row_number=("n", [("id", "asc")]))


@pytest.mark.parametrize("frame", [(-1, 0), (-1, 1), (-3, 2), (1, 1), (-1, -1), (0, 0), (-200, 0)])
def test_row_frames(skewed, many_ranges, frame):
    aggs = {"s": F.sum("x"), "f": F.first("id"), "c": F.count("x")}
    order = [("v", "asc"), ("id", "asc")]
    split = windows.moving(skewed, ["k"], order, frame, aggs, hot_rows=HOT)
    w = Window.partitionBy("k").orderBy("v", "id").rowsBetween(*frame)
    plain = skewed.withColumns({n: a.over(w) for n, a in aggs.items()})
    assert rows_of(split, "id", "s", "f", "c") == rows_of(plain, "id", "s", "f", "c")


def test_cumulative_without_a_key(spark):
    df = spark.range(1, 101).withColumn("one", F.lit(1))
    got = windows.cumulative(df, [], [("id", "desc")], [(F.floor(F.col("id") / 9), "desc")], {"c": "one"})
    assert {r.id: r.c for r in got.collect()} == {i: 101 - i for i in range(1, 101)}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_band_join_and_its_counts(spark, how):
    rng = random.Random(3)

    def side(n, name):
        rows = [
            (rng.choice([1, 1, 1, 2, 3, None, 4 if name == "l" else 5]), f"2024-01-{rng.randint(1, 28):02d}", i)
            for i in range(n)
        ]
        return spark.createDataFrame(rows, f"{name}k int, {name}d string, {name}i int").withColumn(
            f"{name}d", F.col(f"{name}d").cast("timestamp")
        )

    left, right = side(40, "l"), side(90, "r")
    near = (F.col("lk") == F.col("rk")) & (
        F.abs(F.datediff("ld", "rd")) <= 5
    )
    plain = left.join(right, near, how)
    got = joins.band_join(left, right, {"lk": "rk"}, "ld", "rd", 5, how)
    assert rows_of(got, *plain.columns) == rows_of(plain, *plain.columns)
    counts = joins.band_join_counts(left, right, {"lk": "rk"}, "ld", "rd", 5, how, ("a", "b")).first()
    want = plain.agg(F.count("lk").alias("a"), F.count("rk").alias("b")).first()
    assert tuple(counts) == tuple(want)
    dated = [df.withColumn(c, F.to_date(c)) for df, c in ((left, "ld"), (right, "rd"))]
    counts = joins.band_join_counts(*dated, {"lk": "rk"}, "ld", "rd", 5, how, ("a", "b")).first()
    assert tuple(counts) == tuple(want)


def test_pair_counts_match_the_self_join(spark):
    rows = [(1, 1), (1, 2), (1, 2), (1, 3), (2, 4), (None, 5), (None, 6), (3, None), (3, 7), (3, 8)]
    df = spark.createDataFrame(rows, "g int, i int")
    a, b = df.alias("a"), df.alias("b")
    want = (
        a.join(b, F.col("a.g") == F.col("b.g"))
        .filter(F.col("a.i") != F.col("b.i"))
        .groupBy(F.col("a.g").alias("g"))
        .agg(F.count(F.lit(1)).alias("pair_rows"))
    )
    got = joins.self_pair_counts(df, {"g": F.col("g")}, "i")
    assert rows_of(got, "g", "pair_rows") == rows_of(want, "g", "pair_rows")


def test_totals_at_or_above_match_the_join(spark):
    facts = spark.createDataFrame([(1, 5), (1, 2), (4, 1), (9, 7), (None, 3)], "k int, x int")
    points = spark.createDataFrame([(0, "a"), (2, "b"), (4, "c"), (10, "d"), (None, "e")], "p int, n string")
    want = (
        facts.join(points, F.col("k") >= F.col("p"))
        .groupBy("p", "n")
        .agg(F.count(F.lit(1)).alias("c"), F.sum("x").alias("s"))
    )
    got = joins.totals_at_or_above(
        facts, "k", points, "p", {"c": F.count(F.lit(1)), "s": F.sum("x")}, width=3
    )
    assert rows_of(got, "p", "n", "c", "s") == rows_of(want, "p", "n", "c", "s")


def test_except_all_with_many_copies(spark):
    left = spark.createDataFrame([(1, "a")] * 25 + [(2, None)] * 7 + [(3, "c")], "i int, s string")
    right = spark.createDataFrame([(1, "a")] * 3 + [(2, None)] * 2 + [(9, "z")], "a int, b string")
    got = sets.except_all(left, right, chunk_rows=4)
    assert rows_of(got, "i", "s") == rows_of(left.exceptAll(right), "i", "s")


def test_assert_unique_passes_and_fails(spark):
    good = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    assert rows_of(skew.assert_unique(good, ["k"], "t"), "k", "s") == rows_of(good, "k", "s")
    with pytest.raises(Exception, match="occurs more than once"):
        skew.assert_unique(good.unionAll(good), ["k"], "t").collect()


@pytest.mark.parametrize("kind", ["semi", "anti", "merge"])
def test_a_hot_key_is_split_at_run_time(spark, kind):
    """The hot side's partition is split although the other side is an aggregate on the key."""
    from sparrowmill.operators.dml import merge_upsert

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    }
    rows = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.uuid().alias("text")
    )
    keys = spark.range(0, 60_000, 2, 4).select(F.col("id").alias("r"))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        if kind == "merge":
            source = keys.select(F.col("r").alias("k"), F.lit("new").alias("text"))
            done = merge_upsert(
                rows, source, ["k"], {"text": F.col("s_text")},
                {"k": F.col("s_k"), "text": F.col("s_text")},
            )
        else:
            done = getattr(joins, kind)(rows, keys, {"k": "r"})
        done.collect()
        final = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skew=true" in final
    finally:
        for name in settings:
            spark.conf.unset(name)
