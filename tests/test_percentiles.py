"""Exact percentiles against sorting, and the plan that finds them."""

import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import percentiles
from sparrowmill.operators.percentiles import percentile, selected_percentile, sorted_percentile


def plain(rows, fraction):
    groups = defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    out = {}
    for key, values in groups.items():
        held = sorted(v for v in values if v is not None)
        out[key] = held[max(math.ceil(fraction * len(held)), 1) - 1] if held else None
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    kinds = {
        "wide": lambda: rng.uniform(-1e9, 1e9), "narrow": lambda: 5000 + rng.random() / 1000,
        "ties": lambda: rng.choice([1.0, 2.0, 3.0]), "one": lambda: 7.5, "zero": lambda: rng.choice([-0.5, 0.0, 0.5]),
        "tail": lambda: rng.paretovariate(0.5), "nulls": lambda: None, None: lambda: rng.choice([None, 4.0, 9.0]),
    }
    made = [(k, f()) for k, f in kinds.items() for _ in range(rng.choice([1, 2, 301]))]
    made += [("hot", rng.gauss(100, 30)) for _ in range(6000)] + [("two", 1.0), ("two", 2.0)]
    rng.shuffle(made)
    return made


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.5, 0.9, 1.0])
def test_equals_sorting(spark, rows, fraction):
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    want = plain(rows, fraction)
    for way in (sorted_percentile, selected_percentile):
        got = way(df, ["k"], "v", fraction, "p").collect()
        assert len(got) == len(want) and {r["k"]: r["p"] for r in got} == want


def test_large_groups_are_selected(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 3 == 0).alias("k"), F.col("id").alias("v"))
    assert "band" not in percentile(df, ["k"], "v").columns
    taken = lambda d, **o: "band" in percentile(d, ["k"], "v", **o)._jdf.queryExecution().analyzed().toString()
    assert not taken(df, hot_rows=500)  # a small input
    monkeypatch.setattr(percentiles, "SORTED_BYTES", 0)
    assert taken(df, hot_rows=500) and not taken(df, hot_rows=667)


def test_decimals_with_their_mean(spark):
    rng = random.Random(5)
    made = [(i % 7, Decimal(rng.randint(-10**6, 10**6)) / 100) for i in range(3000)] + [(8, None)]
    df = spark.createDataFrame(made, "k int, v decimal(12,2)")
    found = [{r["k"]: (r["median"], r["m"]) for r in way(df, ["k"], "v", 0.5, "median", "m").collect()}
             for way in (sorted_percentile, selected_percentile)]
    got = found[0]
    assert found[0] == found[1]
    held = {k: [v for g, v in made if g == k and v is not None] for k in {g for g, _ in made}}
    assert {k: m for k, (m, _) in got.items()} == plain(made, 0.5)
    assert got == {k: (got[k][0], float(sum(v)) / len(v) if v else None) for k, v in held.items()}


def test_no_rows(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert percentile(none, ["k"], "v").collect() == selected_percentile(none, ["k"], "v", 0.5, "m").collect() == []


def test_no_sketch_and_no_sort_before_the_shuffle(spark, small):
    from sparrowmill.registry import all_queries

    for name in ("approximate_median", "daily_category_metrics"):
        frame = all_queries()[name](spark, small)
        frame.collect()
        text = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "percentile" not in text and "SortAggregate" not in text, name
        assert text.count("ObjectHashAggregate") <= 2 * (name == "daily_category_metrics")  # the category arrays
    orders = spark.read.parquet(f"{small}/orders.parquet")
    daily = orders.select(F.to_date("o_orderdate").alias("d"), "o_totalprice")
    for way in (sorted_percentile, selected_percentile):
        median = way(daily, ["d"], "o_totalprice", 0.5, "median")
        median.collect()
        final = median._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 1
