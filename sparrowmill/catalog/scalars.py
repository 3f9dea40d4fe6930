"""Scalar functions, gathered per kind over the columns of a table."""

from pyspark.sql import functions as F

from sparrowmill.catalog.sql import dbl, iso, iso_ts, with_ctes
from sparrowmill.registry import query


@query("fn_string", "F01 F02 F03 F04 F05 F06 F18", with_ctes("orders_x", """
    SELECT o_orderkey, CAST(length(o_orderpriority) AS INTEGER) AS priority_length,
      concat(o_clerk, '-', o_orderpriority) AS clerk_priority,
      split_part(o_clerk, '#', 2) AS clerk_number, substr(o_clerk, 1, 5) AS clerk_word,
      trim('  ' || o_orderstatus || ' ') AS trimmed,
      format('{:,.2f}', o_totalprice) AS price_text,
      CAST(o_orderkey AS VARCHAR) AS key_text
    FROM orders_x"""))
def fn_string(t):
    return t.orders_x.select(
        "o_orderkey",
        F.length("o_orderpriority").alias("priority_length"),
        F.concat("o_clerk", F.lit("-"), "o_orderpriority").alias("clerk_priority"),
        F.split("o_clerk", "#")[1].alias("clerk_number"),
        F.substring("o_clerk", 1, 5).alias("clerk_word"),
        F.trim(F.concat(F.lit("  "), "o_orderstatus", F.lit(" "))).alias("trimmed"),
        F.format_number("o_totalprice", 2).alias("price_text"),
        F.col("o_orderkey").cast("string").alias("key_text"),
    )


# months_between spelled out: whole months when the days of month agree or both are last days,
# else months plus the day difference over 31, rounded at eight places.
_MONTHS = """round(CASE
      WHEN day(o_orderdate) = 15 THEN
        (year(o_orderdate) - 2001) * 12 + month(o_orderdate) - 1
      ELSE (year(o_orderdate) - 2001) * 12 + month(o_orderdate) - 1
        + (day(o_orderdate) - 15) / 31.0 END, 8)"""


@query("fn_date", "F09 F10 F11 F12 F13 F14 F15", f"""
    SELECT o_orderkey, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
      {_MONTHS} AS months, {_MONTHS} / 12 AS years,
      {iso('CAST(o_orderdate AS DATE) + 10')} AS ten_days_on,
      {iso("o_orderdate + INTERVAL 10 DAY")} AS interval_on,
      {iso("strptime(strftime(o_orderdate, '%m-%d-%Y'), '%m-%d-%Y')")} AS parsed_date,
      {iso_ts("strptime(strftime(o_orderdate, '%m-%d-%Y'), '%m-%d-%Y')")} AS parsed_ts,
      strftime(o_orderdate, '%Y-%m-01') AS month_first, strftime(o_orderdate, '%Y-%-m') AS ym,
      strftime(o_orderdate, '%y-%b') AS year_month_name, CAST(year(o_orderdate) AS INTEGER) AS y,
      CAST(month(o_orderdate) AS INTEGER) AS m, CAST(week(o_orderdate) AS INTEGER) AS w,
      CAST(epoch(o_orderdate) AS BIGINT) AS seconds
    FROM orders""")
def fn_date(t):
    when = F.col("o_orderdate")
    months = F.months_between(when, F.lit("2001-01-15").cast("timestamp"))
    # The stored wall clock read as UTC, whatever the session's time zone.
    as_utc = F.from_utc_timestamp(when.cast("timestamp"), F.current_timezone())
    american = F.date_format(when, "MM-dd-yyyy")
    return t.orders.select(
        "o_orderkey",
        F.datediff(when, F.lit("1995-01-01").cast("date")).alias("days"),
        months.alias("months"),
        (months / 12).alias("years"),
        F.date_add(when, 10).alias("ten_days_on"),
        F.to_date(when + F.expr("INTERVAL '10' DAY")).alias("interval_on"),
        F.to_date(american, "MM-dd-yyyy").alias("parsed_date"),
        F.to_timestamp(american, "MM-dd-yyyy").alias("parsed_ts"),
        F.date_format(when, "yyyy-MM-01").alias("month_first"),
        F.date_format(when, "y-M").alias("ym"),
        F.date_format(when, "yy-MMM").alias("year_month_name"),
        F.year(when).alias("y"),
        F.month(when).alias("m"),
        F.weekofyear(when).alias("w"),
        F.unix_timestamp(as_utc).cast("bigint").alias("seconds"),
    )


@query("fn_math", "F16 F17 F18", f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
      {dbl('round(CAST(l_extendedprice AS DECIMAL(12,2)), 1)')} AS rounded,
      abs(l_quantity - 25) AS distance, CAST(ceil(l_extendedprice) AS BIGINT) AS up,
      CAST(floor(l_extendedprice) AS BIGINT) AS down, CAST(l_quantity AS BIGINT) AS whole,
      CAST(l_quantity - 25 AS BOOLEAN) AS off_centre
    FROM lineitem""")
def fn_math(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.col("l_extendedprice").cast("decimal(12,2)"), 1).alias("rounded"),
        F.abs(F.col("l_quantity") - 25).alias("distance"),
        F.ceil("l_extendedprice").alias("up"),
        F.floor("l_extendedprice").alias("down"),
        F.col("l_quantity").cast("bigint").alias("whole"),
        (F.col("l_quantity") - 25).cast("boolean").alias("off_centre"),
    )


@query("decode_priority", "P20 F07", """
    SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'now'
      WHEN '2-HIGH' THEN 'soon' ELSE 'later' END AS urgency, COUNT(*) AS orders
    FROM orders GROUP BY ALL""")
def decode_priority(t):
    urgency = F.call_function(
        "decode", F.col("o_orderpriority"), F.lit("1-URGENT"), F.lit("now"),
        F.lit("2-HIGH"), F.lit("soon"), F.lit("later"),
    )
    return t.orders.groupBy("o_orderpriority", urgency.alias("urgency")).agg(
        F.count(F.lit(1)).alias("orders")
    )
