"""Set operations that Spark's own operators would run with one task per repeated row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def except_all(left: DataFrame, right: DataFrame, chunk_rows: int = 100_000) -> DataFrame:
    """EXCEPT ALL by position: each row as often as it occurs on the left beyond the right.

    Rows travel as counts, so copies of one row combine map-side. The copies that remain are
    written out again in chunks spread over the cluster, however often a single row occurs.
    """
    columns = left.columns
    signed = left.withColumn("__n", F.lit(1)).unionAll(
        right.toDF(*columns).withColumn("__n", F.lit(-1))
    )
    counted = signed.groupBy(*columns).agg(F.sum("__n").alias("__n")).filter(F.col("__n") > 0)
    last = F.floor((F.col("__n") - 1) / F.lit(chunk_rows))
    chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    # Chunks are dealt over the shuffle's partitions, and what they unfold to is rebalanced by size.
    spread = chunks.repartition(*columns, "__chunk")
    copies = F.least(F.col("__n") - F.col("__chunk") * chunk_rows, F.lit(chunk_rows))
    unfolded = spread.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    return unfolded.select(*columns).hint("rebalance")
