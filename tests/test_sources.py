"""Files, JDBC options, snapshots and storage layout, written and read back."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import layout
from sparrowmill.sources import files, jdbc, snapshots


@pytest.fixture
def where(tmp_path):
    return str(tmp_path / "out")


def test_parquet_modes(spark, where):
    files.write_parquet(spark.range(3), where)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.write_parquet(spark.range(3), where)
    files.write_parquet(spark.range(5), where, mode="overwrite")
    assert files.read_parquet(spark, where).count() == 5


def test_csv_with_and_without_schema(spark, where):
    files.write_csv(spark.createDataFrame([(1, "a,b"), (2, None)], "i int, s string"), where)
    assert files.read_csv(spark, where).columns == ["_c0", "_c1"]
    typed = files.read_csv(spark, where, "i int, s string")
    assert sorted(map(tuple, typed.collect())) == [(1, "a,b"), (2, None)]


def test_delimited_text(spark, tmp_path):
    path = tmp_path / "t.tbl"
    path.write_text('1|Customer#1|"say ""hi""|x"|711.56|1995-03-01|\n2|Customer#2||0.5|1996-01-31|\n')
    got = files.read_delimited(
        spark, str(path), "k bigint, n string, c string, b double, d date"
    ).collect()
    assert got[0].c == 'say "hi"|x' and got[1].c is None
    assert got[1].d == dt.date(1996, 1, 31) and got[0].b == 711.56


def test_shared_folder_comes_from_the_session(spark):
    a, b = files.shared_folder(spark), files.shared_folder(spark)
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_jdbc_options(monkeypatch):
    url, properties = jdbc.connection({"UPSTREAM_HOST": "db", "UPSTREAM_DATABASE": "shop", "UPSTREAM_USERNAME": "u"})
    assert url == "jdbc:postgresql://db:5432/shop" and properties["user"] == "u"
    assert jdbc.partition_options(None, None, None) == {}
    assert jdbc.partition_options("id", (1, 9), 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"
    }
    with pytest.raises(ValueError):
        jdbc.partition_options("id", None, 4)


def test_ranges_at_quantiles_part_all_rows(spark):
    assert jdbc.quantile_query("t", "k", 4) == (
        "(SELECT unnest(percentile_disc(ARRAY[0.25, 0.5, 0.75]) WITHIN GROUP (ORDER BY k)) AS cut FROM t) AS cuts"
    )
    values = [None, *[7] * 500, *range(1000)]
    rows = spark.createDataFrame([(v,) for v in values], "k int")
    for cuts in ([7, 7, 7, 300, 650], [5], [], [None]):
        parts = [rows.where(p).count() for p in jdbc.range_predicates("k", cuts)]
        assert sum(parts) == len(values) and len(parts) == len({c for c in cuts if c}) + 1
    assert max(rows.where(p).count() for p in jdbc.range_predicates("k", [7, 300, 650])) < 600


def test_the_null_mark_is_refused(spark, where):
    rows = spark.createDataFrame([(1, "\0")], "i int, s string")
    with pytest.raises(Exception, match="NUL character"):
        files.write_csv(rows, where)


def test_few_keys_are_sliced_over_buckets(spark, where):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("k"), "id")
    table = layout.write_bucketed(rows, "sliced", where, ["k"], buckets=32, slices=layout.slices_for(rows, ["k"], 32))
    assert table.slices == 11 and table.buckets == 32 and table.even
    assert table.read(spark).columns == ["k", "id"]
    counts = table.read(spark).groupBy("k").count()
    assert sorted(map(tuple, counts.collect())) == [(0, 6667), (1, 6667), (2, 6666)]
    whole = layout.write_bucketed(rows, "unsliced", where + "2", ["id"], buckets=32)
    grouped = whole.read(spark).groupBy("id").count()
    assert whole.slices == 1 and "Exchange hashpartitioning" not in grouped._jdf.queryExecution().executedPlan().toString()
    for made in (table, whole):
        made.drop(spark)
        assert not spark.catalog.tableExists(made.table)
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            made.read_files(spark)


def test_snapshots(spark, where):
    for n, snapshot in ((2, "2024-01-01 10:00:00"), (5, "2024-02-01 10:00:00"), (3, "2024-01-01 10:00:00")):
        snapshots.write_snapshot(spark.range(n), where, "snap", snapshot)
    assert snapshots.list_snapshots(spark, where, "snap") == ["2024-01-01 10:00:00", "2024-02-01 10:00:00"]
    assert snapshots.read_snapshot(spark, where, "snap").count() == 5
    old = snapshots.read_snapshot(spark, where, "snap", at="2024-01-15")
    assert old.count() == 3 and {r.snap for r in old.collect()} == {"2024-01-01 10:00:00"}
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, where, "snap", at="2023-01-01")
    history = snapshots.snapshot_history(snapshots.read_all(spark, where, "snap"), "snap", "id")
    assert {r.snap: (r.rows, r.min_id, r.max_id) for r in history.collect()} == {
        "2024-01-01 10:00:00": (3, 0, 2), "2024-02-01 10:00:00": (5, 0, 4)
    }


def test_snapshot_with_further_partitions(spark, where):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "i int, p string")
    snapshots.write_snapshot(rows, where, "snap", "v1", ["p"])
    assert [r.i for r in snapshots.read_snapshot(spark, where, "snap", p="y").collect()] == [2]


def test_dropped_column_lives_in_the_old_snapshot(spark, where):
    snapshots.write_snapshot(spark.createDataFrame([(1, "c")], "i int, comment string"), where, "snap", "v1")
    snapshots.write_snapshot(spark.createDataFrame([(1, "p")], "i int, phone string"), where, "snap", "v2")
    assert snapshots.read_snapshot(spark, where, "snap").columns == ["i", "phone", "snap"]
    assert snapshots.read_snapshot(spark, where, "snap", at="v1").first().comment == "c"
    assert set(snapshots.read_all(spark, where, "snap").columns) == {"i", "comment", "phone", "snap"}


def test_partitioned_write_prunes(spark, tables, where):
    layout.write_partitioned(tables.lineitem, where, {"ship_year": F.year("l_shipdate")})
    read = spark.read.parquet(where).filter(F.col("ship_year") == 1997)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ship_year" in plan
    assert read.count() == tables.lineitem.filter(F.year("l_shipdate") == 1997).count()


@pytest.mark.parametrize("buckets", [8, 1000])
def test_quantity_buckets_spare_the_shuffle(spark, tables, where, buckets):
    """Fifty values in any number of buckets: bucketed is what the caller gets."""
    name = f"by_quantity_{buckets}"
    table = layout.write_bucketed(tables.lineitem, name, where, ["l_quantity"], buckets=buckets)
    counts = table.read(spark).groupBy("l_quantity").count()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan and counts.count() == 50
    spark.sql(f"DROP TABLE {name}")


def test_buckets_spare_the_shuffle(spark, tables, where):
    table = layout.write_bucketed(tables.lineitem, "by_order", where, ["l_orderkey"], buckets=8, sort=["l_orderkey"])
    assert table.even
    counts = table.read(spark).groupBy("l_orderkey").count()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert counts.count() == tables.lineitem.select("l_orderkey").distinct().count()
    with_orders = layout.write_bucketed(tables.orders, "orders_by_key", where + "2", ["o_orderkey"], buckets=8)
    joined = table.read(spark).hint("merge").join(
        with_orders.read(spark), F.col("l_orderkey") == F.col("o_orderkey")
    )
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE by_order")
    spark.sql("DROP TABLE orders_by_key")


def test_a_hot_bucket_is_read_as_files(spark, where):
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, 1).otherwise(F.col("id")).alias("k"))
    table = layout.write_bucketed(rows, "hot_table", where, ["k"], buckets=16)
    assert not table.even
    plan = table.read_files(spark).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" not in plan and table.read_files(spark).count() == 3000
    assert table.read(spark).count() == 3000
    spark.sql("DROP TABLE hot_table")


def test_sorted_files_are_smaller(spark, tables, tmp_path):
    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "sorted")
    narrow = tables.lineitem.select("l_quantity", "l_returnflag", "l_linestatus").orderBy(F.hash("l_extendedprice"))
    narrow.write.parquet(plain)
    layout.write_sorted(narrow, ordered, ["l_quantity", "l_returnflag", "l_linestatus"], partitions=4)
    assert layout.dataset_bytes(spark, ordered) < layout.dataset_bytes(spark, plain)
    assert spark.read.parquet(ordered).count() == 60_000


def test_sized_files(spark, tables, where):
    layout.write_sized(tables.orders, where, rows_per_file=4000)
    counts = spark.read.parquet(where).groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in counts) == 15_000 and max(r["count"] for r in counts) <= 4000


def test_catalog_statistics(spark, tables):
    spark.sql("DROP TABLE IF EXISTS stat_orders")
    tables.orders.write.saveAsTable("stat_orders")
    spark.sql("ANALYZE TABLE stat_orders COMPUTE STATISTICS FOR ALL COLUMNS")
    info = {r["info_name"]: r["info_value"] for r in spark.sql("DESC EXTENDED stat_orders o_custkey").collect()}
    assert info["num_nulls"] == "0" and int(info["distinct_count"]) > 800
    spark.sql("INSERT INTO stat_orders SELECT * FROM stat_orders")
    assert spark.table("stat_orders").count() == 30_000
    spark.sql("DROP TABLE stat_orders")


def test_text_comes_back_as_it_was(spark, where):
    rows = [(1, " pad "), (2, ""), (3, None), (4, 'say "hi"|x, y'), (5, "two\nlines"), (6, '"'), (7, "\\")]
    for sep, read in (("|", files.read_delimited), (",", files.read_csv)):
        path = f"{where}-{ord(sep)}"
        files.write_csv(spark.createDataFrame(rows, "i int, s string"), path, sep=sep)
        assert sorted(map(tuple, read(spark, path, "i int, s string", line_breaks=True).collect())) == rows
    rows += [(8, "\\n"), (9, "\\\n"), (10, "\n\\\\\r"), (11, "\\\\n\\"), (12, "a\r\nb")]
    for sep, read in (("|", files.read_delimited), (",", files.read_csv)):
        path = f"{where}-escaped-{ord(sep)}"
        files.write_csv(spark.createDataFrame(rows, "i int, s string"), path, sep=sep, escape_breaks=True)
        assert sorted(map(tuple, read(spark, path, "i int, s string", escaped_breaks=True).collect())) == rows


def test_versions_compare_by_kind(spark, where):
    for version in ("9", "10", "01"):
        snapshots.write_snapshot(spark.range(int(version)), where, "v", version)
    assert snapshots.list_snapshots(spark, where, "v", int) == ["01", "9", "10"]
    assert snapshots.read_snapshot(spark, where, "v", kind=int).count() == 10
    assert snapshots.read_snapshot(spark, where, "v", "9", kind=int).count() == 9
    assert {r[0] for r in snapshots.read_all(spark, where, "v").select("v").distinct().collect()} == {"9", "10", "01"}


def test_a_replaced_snapshot_is_never_lost(spark, where):
    def refuse(df):
        raise ValueError("no")

    snapshots.write_checked_snapshot(spark.range(3), where, "v", "1", lambda df: None)
    with pytest.raises(ValueError, match="no"):
        snapshots.write_checked_snapshot(spark.range(4), where, "v", "1", refuse)
    assert snapshots.read_snapshot(spark, where, "v").count() == 3
    snapshots.write_checked_snapshot(spark.range(5), where, "v", "1", lambda df: None)
    assert snapshots.read_snapshot(spark, where, "v").count() == 5
    assert snapshots.clear_aside(spark, where) == 1 and snapshots.clear_aside(spark, where) == 0


def test_upstream_tables_ask_for_bounds(monkeypatch):
    asked = []

    class Bounds:
        def head(self):
            return {"low": 3, "high": 90}

    def read(spark, table, *how):
        asked.append((table, *how))
        return Bounds()

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    jdbc.upstream_tables(None, {"brand": ("x", (1, 2), 3)}, connections=4)("brand")
    jdbc.upstream_tables(None, connections=4)("orders")
    assert asked[0] == ("brand", "x", (1, 2), 3)
    assert "MIN(order_id)" in asked[1][0] and asked[2] == ("orders", "order_id", (3, 90), 4)


def test_analyze(spark, tiny, where):
    from sparrowmill.operators.stats import analyze

    spark.read.parquet(f"{tiny}/nation.parquet").write.option("path", where).saveAsTable("analyzed")
    found = analyze(spark, "analyzed", ["n_nationkey"])
    spark.sql("DROP TABLE analyzed")
    assert "25 rows" in found["table"] and "distinct_count=25" in found["n_nationkey"]


def test_parked_folders_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_PARKED", [])
    one = files.shared_folder(spark)
    files.shared_folder(spark)  # named, never written
    files.write_parquet(spark.range(3), one)
    assert files.clear_shared_folders(spark) == 1 and files.clear_shared_folders(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_parquet(spark, one)
