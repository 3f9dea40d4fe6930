"""Type 2 history, DML rewrites, snapshots and schema changes."""

import uuid

from pyspark.sql import functions as F

from sparrowmill.catalog.sql import dbl, iso_ts, with_ctes
from sparrowmill.operators import dml, scd2
from sparrowmill.plans import gold
from sparrowmill.registry import query
from sparrowmill.sources import snapshots
from sparrowmill.sources.files import shared_folder, write_parquet

KEY, TRACKED, TS = "id", ["name", "age"], "updated_at"
FIRST, SECOND = "2024-01-11", "2024-01-21"


def change_log(t):
    """User changes: (id, name, age, updated_at), one row per user and time."""
    return t.events.select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("name"),
        F.floor("value").cast("int").alias("age"),
        F.col("ts").alias("updated_at"),
    )


def snapshot(t, before):
    """The latest row per user before a day; combined map-side, so no user is held whole."""
    latest = F.max(F.struct("updated_at", "name", "age")).alias("v")
    rows = change_log(t).filter(F.col("updated_at") < F.lit(before).cast("date"))
    return rows.groupBy("id").agg(latest).select("id", "v.name", "v.age", "v.updated_at")


def first_history(t):
    incoming = snapshot(t, FIRST)
    empty = scd2.empty_history(t.spark, incoming, KEY, TRACKED, TS)
    return scd2.scd2_apply(empty, incoming, KEY, TRACKED, TS)


_LOG = """SELECT user_id AS id, event_type AS name, CAST(floor(value) AS INTEGER) AS age,
      ts AS updated_at FROM events"""


def _snap(before):
    return f"""SELECT id, name, age, updated_at FROM log WHERE updated_at < DATE '{before}'
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1"""


def _snaps(body):
    return with_ctes("", body, log=_LOG, s1=_snap(FIRST), s2=_snap(SECOND))


_DIFF = "(s1.name IS DISTINCT FROM s2.name OR s1.age IS DISTINCT FROM s2.age)"
_NEW = f"""SELECT s2.id, s2.name, s2.age, {iso_ts('s2.updated_at')} AS start_date,
      CAST(NULL AS VARCHAR) AS end_date, TRUE AS is_active
    FROM s2 LEFT JOIN s1 ON s1.id = s2.id WHERE s1.id IS NULL OR {_DIFF}"""
_CLOSED = f"""SELECT s1.id, s1.name, s1.age, {iso_ts('s1.updated_at')} AS start_date,
      {iso_ts('s2.updated_at')} AS end_date, FALSE AS is_active
    FROM s1 JOIN s2 ON s1.id = s2.id WHERE {_DIFF}"""
_KEPT = f"""SELECT s1.id, s1.name, s1.age, {iso_ts('s1.updated_at')} AS start_date,
      CAST(NULL AS VARCHAR) AS end_date, TRUE AS is_active
    FROM s1 LEFT JOIN s2 ON s1.id = s2.id WHERE s2.id IS NULL OR NOT {_DIFF}"""


@query("scd2_initial", "D04 S13", _snaps(f"""
    SELECT id, name, age, {iso_ts('updated_at')} AS start_date, CAST(NULL AS VARCHAR) AS end_date,
      TRUE AS is_active FROM s1"""))
def scd2_initial(t):
    return first_history(t)


@query("scd2_changes", "D01", _snaps(_NEW))
def scd2_changes(t):
    return scd2.scd2_changes(first_history(t), snapshot(t, SECOND), KEY, TRACKED, TS)


@query("scd2_closed", "D02", _snaps(_CLOSED))
def scd2_closed(t):
    return scd2.scd2_closed(first_history(t), snapshot(t, SECOND), KEY, TRACKED, TS)


@query("scd2_apply", "D03 O10", _snaps(f"{_NEW} UNION ALL {_CLOSED} UNION ALL {_KEPT}"))
def scd2_apply(t):
    return scd2.scd2_apply(first_history(t), snapshot(t, SECOND), KEY, TRACKED, TS)


@query("scd2_rejected", "D01 D03", _snaps(f"""
    SELECT id, s3.name, s3.age, {iso_ts('s3.updated_at')} AS updated_at
    FROM (SELECT id, name, age, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN
        updated_at - INTERVAL 400 DAY ELSE updated_at END AS updated_at FROM s2) s3
      JOIN s1 USING (id)
    WHERE (s1.name IS DISTINCT FROM s3.name OR s1.age IS DISTINCT FROM s3.age)
      AND (s3.updated_at IS NULL OR s3.updated_at <= s1.updated_at)"""))
def scd2_rejected(t):
    """Changed rows without a time, or no newer than the active version: handed back, not applied."""
    when = F.when(F.col("id") % 5 == 0, None).when(
        F.col("id") % 5 == 1, F.col(TS) - F.expr("INTERVAL 400 DAY")
    )
    incoming = snapshot(t, SECOND).withColumn(TS, when.otherwise(F.col(TS)))
    return scd2.scd2_late(first_history(t), incoming, KEY, TRACKED, TS)


_HISTORY = {
    "log": _LOG,
    "marked": """SELECT *, row_number() OVER w = 1
        OR lag(name) OVER w IS DISTINCT FROM name OR lag(age) OVER w IS DISTINCT FROM age AS changed
      FROM log WINDOW w AS (PARTITION BY id ORDER BY updated_at)""",
    "history": """SELECT id, name, age, updated_at AS start_date,
        lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS end_date
      FROM marked WHERE changed""",
}
_HISTORY_ROWS = f"""{iso_ts('start_date')} AS start_date, {iso_ts('end_date')} AS end_date,
      end_date IS NULL AS is_active"""


@query("scd2_from_log", "D05", with_ctes("", f"""
    SELECT id, name, age, {iso_ts('h.start_date')} AS start_date,
      {iso_ts('h.end_date')} AS end_date, h.end_date IS NULL AS is_active FROM history h""", **_HISTORY))
def scd2_from_log(t):
    return scd2.scd2_from_log(change_log(t), KEY, TRACKED, TS)


@query("scd2_invariants", "S03 D06", with_ctes("", """
    SELECT 'active_with_end_date' AS rule, COUNT(*) FILTER (a AND end_date IS NOT NULL) AS violations
    FROM h UNION ALL
    SELECT 'closed_without_end_date', COUNT(*) FILTER (NOT a AND end_date IS NULL) FROM h UNION ALL
    SELECT 'several_active', COUNT(*) FROM (
      SELECT id FROM h WHERE a GROUP BY id HAVING COUNT(*) > 1) UNION ALL
    SELECT 'overlapping', COUNT(*) FROM (
      SELECT *, lead(start_date) OVER (PARTITION BY id ORDER BY start_date) AS nxt FROM h)
    WHERE nxt IS NOT NULL AND (end_date IS NULL OR end_date > nxt)""",
    **_HISTORY, h="SELECT *, end_date IS NULL AS a FROM history"))
def scd2_invariants(t):
    # The checks read the history several times, so it is stored first, as a history is.
    path = shared_folder(t.spark)
    write_parquet(scd2.scd2_from_log(change_log(t), KEY, TRACKED, TS), path)
    return scd2.scd2_violations(t.spark.read.parquet(path), KEY)


@query("scd2_report", "D07 V05", with_ctes("", f"""
    SELECT id, h.end_date IS NULL AS is_active, {iso_ts('h.start_date')} AS start_date,
      {iso_ts('h.end_date')} AS end_date, name, age FROM history h""", **_HISTORY))
def scd2_report(t):
    return gold.scd_users_report(scd2.scd2_from_log(change_log(t), KEY, TRACKED, TS))


@query("dml_insert_select", "D08", """
    SELECT CAST(1 AS BIGINT) AS sample_key, 'hello' AS sample_status
    UNION ALL SELECT CAST(1 AS BIGINT), 'hello'
    UNION ALL SELECT c_custkey, c_name FROM customer""")
def dml_insert_select(t):
    table = t.spark.createDataFrame([], "sample_key bigint, sample_status string")
    hello = t.spark.createDataFrame([(1, "hello")], "k int, s string")
    for rows in (hello, hello, t.customer.select("c_custkey", "c_name")):
        table = dml.insert_into(table, rows)
    return table


@query("dml_table_cycle", "D08", """
    SELECT 1::BIGINT AS step, COUNT(*) + 2 AS table_rows FROM customer
    UNION ALL SELECT 2, 0 UNION ALL SELECT 3, COUNT(*) FROM part""")
def dml_table_cycle(t):
    """Rows of a catalog table after inserts, after deleting all, and after another insert; the
    table is dropped in the end."""
    table = dml.CatalogTable(
        t.spark, f"sample_{uuid.uuid4().hex}", "sample_key bigint, sample_status string", shared_folder(t.spark)
    )
    seen = []
    table.insert_values((1, "hello"), (1, "hello"))
    table.insert_select(t.customer.select("c_custkey", "c_name"))
    seen.append((1, table.read().count()))
    table.delete_all()
    seen.append((2, table.read().count()))
    table.insert_select(t.part.select("p_partkey", "p_name"))
    seen.append((3, table.read().count()))
    table.drop(purge=True)
    return t.spark.createDataFrame(seen, "step long, table_rows long")


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipmode"]


@query("dml_delete_where", "D09", with_ctes("lineitem_x", f"""
    SELECT {', '.join(_LINE_KEYS)} FROM lineitem_x WHERE l_shipmode <> 'TRUCK'"""))
def dml_delete_where(t):
    return dml.delete_where(t.lineitem_x, F.col("l_shipmode") == "TRUCK").select(*_LINE_KEYS)


@query("dml_update_where", "D10", with_ctes("lineitem_x", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_shipmode = 'REG AIR' THEN 'AIR' ELSE l_shipmode END AS l_shipmode
    FROM lineitem_x"""))
def dml_update_where(t):
    return dml.update_where(
        t.lineitem_x.select(*_LINE_KEYS), F.col("l_shipmode") == "REG AIR", {"l_shipmode": F.lit("AIR")}
    )


@query("dml_merge", "D11", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '_A_CUSTOMER'
      ELSE c_name END AS name, 1 AS active FROM customer""")
def dml_merge(t):
    target = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.col("c_name").alias("name"), F.lit(0).alias("active")
    )
    source = t.customer.select("c_custkey", F.col("c_name").alias("name"))
    return dml.merge_upsert(
        target,
        source,
        ["c_custkey"],
        update={"name": F.concat("s_name", F.lit("_"), F.lit("A_CUSTOMER")), "active": F.lit(1)},
        insert={"c_custkey": F.col("s_c_custkey"), "name": F.col("s_name"), "active": F.lit(1)},
    )


SNAP = "snapshot_id"
V1, V2 = "2024-01-01", "2024-02-01"


def two_versions(t):
    """Orders until 1998 as the first snapshot, all orders as the second."""
    path = shared_folder(t.spark)
    early = t.orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("date"))
    snapshots.write_snapshot(early, path, SNAP, V1)
    snapshots.write_snapshot(t.orders, path, SNAP, V2)
    return path


_SNAP_COLUMNS = f"o_orderkey, o_custkey, o_totalprice, '{{}}' AS {SNAP}"


@query("latest_snapshot", "S08 S10 A18", f"SELECT {_SNAP_COLUMNS.format(V2)} FROM orders")
def latest_snapshot(t):
    return snapshots.read_snapshot(t.spark, two_versions(t), SNAP).select(
        "o_orderkey", "o_custkey", "o_totalprice", SNAP
    )


@query("snapshot_as_of", "D13", f"""
    SELECT {_SNAP_COLUMNS.format(V1)} FROM orders WHERE o_orderdate < DATE '1999-01-01'""")
def snapshot_as_of(t):
    return snapshots.read_snapshot(t.spark, two_versions(t), SNAP, at="2024-01-15").select(
        "o_orderkey", "o_custkey", "o_totalprice", SNAP
    )


@query("snapshot_history", "D12", f"""
    SELECT '{V1}' AS {SNAP}, COUNT(*) AS "rows", MIN(o_orderkey) AS min_o_orderkey,
      MAX(o_orderkey) AS max_o_orderkey FROM orders WHERE o_orderdate < DATE '1999-01-01'
    UNION ALL SELECT '{V2}', COUNT(*), MIN(o_orderkey), MAX(o_orderkey) FROM orders""")
def snapshot_history(t):
    every = snapshots.read_all(t.spark, two_versions(t), SNAP)
    return snapshots.snapshot_history(every, SNAP, "o_orderkey")


@query("schema_evolution", "D14 S09", with_ctes("orders_x", f"""
    SELECT '{V1}' AS {SNAP}, COUNT(*) AS "rows", COUNT(o_comment) AS comments, CAST(0 AS BIGINT) AS phones
    FROM orders_x UNION ALL SELECT '{V2}', COUNT(*), 0, 0 FROM orders_x"""))
def schema_evolution(t):
    path = shared_folder(t.spark)
    snapshots.write_snapshot(t.orders_x, path, SNAP, V1)
    altered = dml.evolve(t.orders_x, add={"phonenumber": "string"}, drop=["o_comment"])
    snapshots.write_snapshot(altered, path, SNAP, V2)
    return snapshots.read_all(t.spark, path, SNAP).groupBy(SNAP).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("o_comment").alias("comments"),
        F.count("phonenumber").alias("phones"),
    )


def _order_lines(orders, lineitem):
    """Each order with its number of lines."""
    lines = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "o_custkey", F.coalesce("lines", F.lit(0)).alias("lines")
    )


_LINES_SQL = """(SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)
    ON o_orderkey = l_orderkey"""


@query("refresh_insert", "D15", f"""
    SELECT o_orderkey, o_custkey, COALESCE(n, 0) AS lines FROM orders LEFT JOIN {_LINES_SQL}
    UNION ALL
    SELECT -1 - o_orderkey, o_custkey, COALESCE(n, 0) FROM orders LEFT JOIN {_LINES_SQL}
    WHERE o_orderdate >= DATE '2001-01-01'""")
def refresh_insert(t):
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("date"))
    lines = t.lineitem.join(recent, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return _order_lines(
        *dml.apply_refresh(
            t.orders,
            t.lineitem,
            new_orders=recent.withColumn("o_orderkey", -1 - F.col("o_orderkey")),
            new_lineitem=lines.withColumn("l_orderkey", -1 - F.col("l_orderkey")),
        )
    )


@query("refresh_delete", "D15", f"""
    SELECT o_orderkey, o_custkey, COALESCE(n, 0) AS lines FROM orders LEFT JOIN {_LINES_SQL}
    WHERE o_orderdate >= DATE '1996-01-01'""")
def refresh_delete(t):
    old = t.orders.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("date"))
    orders, lineitem = dml.apply_refresh(
        t.orders, t.lineitem, delete_keys=old.select("o_orderkey")
    )
    return _order_lines(orders, lineitem)
