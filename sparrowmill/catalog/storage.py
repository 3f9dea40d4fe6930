"""Storage layout, statistics, catalog listing and pushed-down filters."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.catalog.sql import dbl, iso, with_ctes
from sparrowmill.operators import dml, layout
from sparrowmill.operators import plan_report as plans
from sparrowmill.operators.joins import join_with_strategy
from sparrowmill.operators.stats import profile
from sparrowmill.registry import query
from sparrowmill.sources.files import (
    read_csv,
    read_delimited,
    shared_folder,
    text_format,
    write_csv,
    write_parquet,
)


@query("partition_pruned_read", "L01 F14 F18", """
    SELECT l_returnflag, CAST(month(l_shipdate) AS INTEGER) AS ship_month, COUNT(*) AS lines,
      SUM(l_quantity) AS quantity FROM lineitem
    WHERE year(l_shipdate) = 1997 GROUP BY ALL""")
def partition_pruned_read(t):
    path = shared_folder(t.spark)
    layout.write_partitioned(t.lineitem, path, {"ship_year": F.year("l_shipdate")})
    return (
        t.spark.read.parquet(path)
        .filter(F.col("ship_year") == 1997)
        .groupBy("l_returnflag", F.month("l_shipdate").alias("ship_month"))
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    )


def outliving(t, result):
    """A result, a row per group, stored so that the table it was read from can go."""
    path = shared_folder(t.spark)
    write_parquet(result, path)
    return t.spark.read.parquet(path)


def _by_quantity(t, sort):
    table = layout.write_bucketed(
        t.lineitem,
        f"lineitem_by_quantity_{uuid.uuid4().hex}",
        shared_folder(t.spark),
        ["l_quantity"],
        sort=sort,
    )
    counts = outliving(t, table.read(t.spark).groupBy("l_quantity").agg(F.count(F.lit(1)).alias("cnt")))
    table.drop(t.spark)
    return counts


_QUANTITY_SQL = "SELECT l_quantity, COUNT(*) AS cnt FROM lineitem GROUP BY l_quantity"


@query("bucketed_group", "L02", _QUANTITY_SQL)
def bucketed_group(t):
    return _by_quantity(t, ())


@query("bucket_sorted_group", "L03", _QUANTITY_SQL)
def bucket_sorted_group(t):
    return _by_quantity(t, ("l_quantity",))


@query("suppkey_qty", "L05 S04 S05", """
    SELECT l_suppkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey""")
def suppkey_qty(t):
    """The supplier sum over the row format: the table written as text, read back typed."""
    path = shared_folder(t.spark)
    write_csv(t.lineitem, path)
    rows = read_csv(t.spark, path, t.lineitem.schema)
    return rows.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))


@query("csv_table_insert", "S07 L05", """
    SELECT l_suppkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey""")
def csv_table_insert(t):
    """The supplier sum over a typed CSV table that INSERT ... SELECT fills from the Parquet one."""
    name, path = f"lineitem_csv_{uuid.uuid4().hex}", shared_folder(t.spark)
    table = dml.CatalogTable(t.spark, name, t.lineitem.schema, path, using="csv")
    table.insert_select(t.lineitem)
    sums = outliving(
        t, t.spark.sql(f"SELECT l_suppkey, SUM(l_quantity) AS quantity FROM `{name}` GROUP BY l_suppkey")
    )
    table.drop(purge=True)
    return sums


def hard_texts(t):
    """Orders with a text column that needs care: quotes, spaces, empty, line breaks, a backslash, null."""
    kind = F.col("o_orderkey") % 6
    hard = F.when(kind == 0, 'say "hi"|x').when(kind == 1, " pad ").when(kind == 2, "")
    hard = hard.when(kind == 3, "two\nlines").when(kind == 4, "back\\n").otherwise(F.lit(None))
    return t.orders_x.drop("o_buyerkey").withColumn("o_comment", hard)


_HARD_SQL = """CASE o_orderkey % 6 WHEN 0 THEN 'say "hi"|x' WHEN 1 THEN ' pad ' WHEN 2 THEN ''
        WHEN 3 THEN 'two' || chr(10) || 'lines' WHEN 4 THEN 'back' || chr(92) || 'n' END"""


@query("text_table_select", "S07", with_ctes("orders_x", f"""
    SELECT o_comment IS NULL AS no_text, o_comment, length(o_comment) AS chars, COUNT(*) AS orders,
      SUM(o_orderkey) AS keys FROM (SELECT o_orderkey, {_HARD_SQL} AS o_comment FROM orders_x) GROUP BY ALL"""))
def text_table_select(t):
    """SELECT through a typed text table, whose options give back the hard texts that INSERT wrote."""
    name, rows = f"orders_text_{uuid.uuid4().hex}", hard_texts(t)
    table = dml.CatalogTable(
        t.spark, name, rows.schema, shared_folder(t.spark), using="csv", options=text_format("|", line_breaks=True)
    )
    table.insert_select(rows)
    texts = outliving(t, t.spark.sql(f"""SELECT o_comment IS NULL AS no_text, o_comment,
        length(o_comment) AS chars, COUNT(*) AS orders, SUM(o_orderkey) AS keys FROM `{name}` GROUP BY ALL"""))
    table.drop(purge=True)
    return texts


@query("delimited_table", "S06", with_ctes("orders_x", f"""
    SELECT * EXCLUDE (o_buyerkey) REPLACE ({iso('o_orderdate')} AS o_orderdate,
      {_HARD_SQL} AS o_comment) FROM orders_x"""))
def delimited_table(t):
    """Orders as separated text, with a text column that needs care, read back into a typed table."""
    path, rows = shared_folder(t.spark), hard_texts(t)
    write_csv(rows, path, sep="|", escape_breaks=True)
    stored = read_delimited(t.spark, path, rows.schema, escaped_breaks=True)
    return stored.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("sorted_write_group", "L04 O03", _QUANTITY_SQL)
def sorted_write_group(t):
    """The quantity counts over files sorted by quantity; the order key splits large quantities."""
    path = shared_folder(t.spark)
    order = ["l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    layout.write_sorted(t.lineitem, path, order)
    return t.spark.read.parquet(path).groupBy("l_quantity").agg(F.count(F.lit(1)).alias("cnt"))


@query("sized_write", "L06", """
    SELECT COUNT(*) AS "rows", TRUE AS within_size FROM lineitem""")
def sized_write(t):
    """Rows of a table written in files of bounded length, and whether every file keeps to it."""
    path, most = shared_folder(t.spark), 50_000
    layout.write_sized(t.lineitem, path, rows_per_file=most)
    files = (
        t.spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= most).alias("within_size"))


_PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("table_profile", "L07", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", COUNT(*) AS "rows", COUNT(*) - COUNT({c}) AS nulls,
      CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value,
      {dbl(f'SUM(length(CAST({c} AS VARCHAR)))')} / COUNT({c}) AS avg_length,
      CAST(MAX(length(CAST({c} AS VARCHAR))) AS INTEGER) AS max_length, COUNT(DISTINCT {c}) AS distinct_values
    FROM orders""" for c in _PROFILED))
def table_profile(t):
    return profile(t.orders, exact_distinct=True)


_LISTED = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")


@query("catalog_columns", "L08 A01", "SELECT * FROM (" + " UNION ALL ".join(f"""
    SELECT table_name, column_name, (SELECT COUNT(*) FROM {n}) AS row_count
    FROM information_schema.columns WHERE table_name = '{n}'""" for n in _LISTED) + ")")
def catalog_columns(t):
    """Every column the catalog lists for the tables, with the table's row count."""
    views = {f"listed_{uuid.uuid4().hex}_{name}": name for name in _LISTED}
    for view, name in views.items():
        t.read(name).createTempView(view)
    listed = [(views[v], column.name) for v in views for column in t.spark.catalog.listColumns(v)]
    for view in views:
        t.spark.catalog.dropTempView(view)
    columns = t.spark.createDataFrame(listed, "table_name string, column_name string")
    counts = reduce(
        DataFrame.unionByName,
        [
            t.read(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            for n in _LISTED
        ],
    )
    return columns.join(counts, "table_name")


@query("filter_after_agg", "L10", """
    SELECT l_linestatus, COUNT(*) AS cnt FROM lineitem WHERE l_linestatus <> 'O'
    GROUP BY l_linestatus""")
def filter_after_agg(t):
    counts = t.lineitem.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.filter(F.col("l_linestatus") != "O")


@query("plan_report", "L09", """
    SELECT 'pushed filter' AS query, 'lineitem' AS "table", 1 AS scans, 0 AS joins, 0 AS exchanges,
      TRUE AS pushed, 2 AS columns, COUNT(*) AS rows_kept FROM lineitem WHERE l_quantity < 3
    UNION ALL SELECT 'group', 'lineitem', 1, 0, 1, FALSE, 2, COUNT(DISTINCT l_suppkey) FROM lineitem
    UNION ALL SELECT 'broadcast join', 'nation', 2, 1, 1, FALSE, 2, COUNT(*) FROM nation""")
def plan_report(t):
    """What three queries really ran: scans, joins, exchanges, the first scan and the rows put out."""
    few = t.lineitem.where("l_quantity < 3").select("l_orderkey")
    sums = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    named = join_with_strategy(
        t.nation.select("n_name", "n_regionkey"), t.region.select("r_regionkey", "r_name"),
        F.col("n_regionkey") == F.col("r_regionkey"), strategy="broadcast",
    )
    report = plans.plan_report(t.spark, {"pushed filter": few, "group": sums, "broadcast join": named})
    scan = F.col("operator").contains("Scan")
    join = F.col("operator").endswith("Join")
    exchange = F.col("operator").isin("ShuffleExchange", "BroadcastExchange")
    first = F.min_by(F.struct("table", "columns", "pushed"), F.when(scan, F.col("step")))
    put_out = F.min_by("rows", F.when(F.col("rows") >= 0, F.col("step")))
    return report.groupBy("query").agg(
        F.count_if(scan).cast("int").alias("scans"), F.count_if(join).cast("int").alias("joins"),
        F.count_if(exchange).cast("int").alias("exchanges"), first.alias("first"), put_out.alias("rows_kept"),
    ).select(
        "query", "first.table", "scans", "joins", "exchanges", "first.columns",
        F.col("first.pushed").contains("LessThan").alias("pushed"), "rows_kept",
    )
