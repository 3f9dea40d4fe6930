"""Table and column statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> dict[str, str]:
    """ANALYZE TABLE ... COMPUTE STATISTICS, for named columns too, which the cost-based optimizer
    reads; the table's statistics as DESCRIBE EXTENDED then tells them, and each column's."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    found = {}
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect():
        if row["col_name"] == "Statistics":
            found["table"] = row["data_type"]
    for column in columns:
        facts = spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()
        found[column] = ", ".join(f"{r['info_name']}={r['info_value']}" for r in facts)
    return found


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False
) -> DataFrame:
    """One row per column: rows, nulls, distinct values, min, max, average and longest length.

    A single aggregate pass. Distinct counts are estimates, as catalog statistics are; with
    ``exact_distinct`` each column's values are counted exactly, one narrow scan and shuffle per
    column, combined map-side.
    """
    columns = list(columns or df.columns)
    measures = []
    for c in columns:
        text = F.col(c).cast("string")
        measures += [
            F.count(c).alias(f"n_{c}"),
            F.min(c).cast("string").alias(f"min_{c}"),
            F.max(c).cast("string").alias(f"max_{c}"),
            F.sum(F.length(text)).alias(f"chars_{c}"),
            F.max(F.length(text)).alias(f"longest_{c}"),
        ]
        if not exact_distinct:
            measures.append(F.approx_count_distinct(c).alias(f"ndv_{c}"))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *measures)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n_{c}")).alias("nulls"),
                F.col(f"min_{c}").alias("min_value"),
                F.col(f"max_{c}").alias("max_value"),
                F.try_divide(F.col(f"chars_{c}"), F.col(f"n_{c}")).alias("avg_length"),
                F.col(f"longest_{c}").alias("max_length"),
                *([] if exact_distinct else [F.col(f"ndv_{c}").alias("distinct_values")]),
            )
            for c in columns
        ]
    )
    report = wide.select(F.explode(rows).alias("r")).select("r.*")
    if not exact_distinct:
        return report
    counted = reduce(
        DataFrame.unionByName,
        [
            df.select(F.col(c)).filter(F.col(c).isNotNull()).distinct().agg(
                F.lit(c).alias("column"), F.count(F.lit(1)).alias("distinct_values")
            )
            for c in columns
        ],
    )
    return report.join(counted, "column", "left")
