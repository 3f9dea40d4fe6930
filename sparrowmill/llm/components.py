"""Connected components of a graph of links, as rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.common import stored
from sparrowmill.operators.skew import apart


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b longs); root is its component's least node.

    Alternates two steps until nothing changes: every node links its larger neighbours to the least
    of its neighbourhood, then its smaller ones. Neighbourhoods are never gathered: their minimum is
    an aggregate with a map-side combine, and the join back can split a hot node. Each round is
    written to the shared folder.
    """
    graph = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        now = graph.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head()
        if now == state or not now[0]:
            break
        state = now
        both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(apart(least), "u")
        large = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(apart(least), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        graph = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    roots = graph.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return graph.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
