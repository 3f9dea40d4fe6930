"""Sharding along a Hilbert curve over quantised metadata, cut into runs of equal size."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sparrowmill.llm.common import positions, stored, text_of

ROW_BYTES = 16  # counted for a row besides its text
DIMENSIONS = ("lang", "source", "n_chars", "doc_id")
BITS = 5


def hilbert_index(axes: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits``-bit coordinates.

    Walks the bit planes from the top. In each plane the current sub-cube's orientation is undone
    (exchanging or inverting the lower bits of the axes), then the planes' bits are read as a Gray
    code.
    """
    x = [np.asarray(a, np.int64).copy() for a in axes]
    dims = len(x)
    plane = 1 << (bits - 1)
    while plane > 1:
        low = plane - 1
        for i in range(dims):
            inverted = (x[i] & plane) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            x[i] ^= swap
        plane >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    plane = 1 << (bits - 1)
    while plane > 1:
        flip ^= np.where(x[-1] & plane, plane - 1, 0)
        plane >>= 1
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> bit) & 1)
    return index


def _ordered(df: DataFrame, name: str) -> Column:
    """A column as a number or whole text that keeps its order, null first."""
    if dict(df.dtypes)[name] == "string":
        return F.coalesce(F.concat(F.lit("+"), F.col(name)), F.lit(""))
    return F.coalesce(F.col(name).cast("double"), F.lit(-1.0))


def _at_or_below(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda edge: edge <= value))


def _text_cuts(df: DataFrame, name: str, cells: int) -> list[str]:
    """The least value of each cell but the first, when values are cut by their rank: a value goes to
    the cell that the middle of its rows, in the order of all values, falls into."""
    values = df.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("size"))
    placed, number = _by_bytes(positions(values, [F.col("value")]), cells)
    least = placed.groupBy(number.alias("cell")).agg(F.min("value").alias("value")).collect()
    return sorted(r["value"] for r in least)[1:]


def quantised(df: DataFrame, dimensions: Sequence[str], bits: int) -> list[Column]:
    """Each dimension's cell, 0 to 2**bits - 1, between quantiles over the whole table. Text is
    compared whole, by its bytes."""
    cells = 1 << bits
    shares = [i / cells for i in range(1, cells)]
    kinds = dict(df.dtypes)
    numbers = [d for d in dimensions if kinds[d] != "string"]
    cuts = df.select(*[F.percentile_approx(F.col(d), shares, 2000).alias(d) for d in numbers]).head() if numbers else {}
    out = []
    for d in dimensions:
        if kinds[d] == "string":
            edges = F.array(*[F.lit(c) for c in _text_cuts(df, d, cells)]).cast("array<string>")
        else:
            edges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts[d] or []))]).cast("array<double>")
        out.append(_at_or_below(edges, F.col(d)))
    return out


def shard(
    documents: DataFrame,
    shards: int = 40,
    law: str = "rows",
    dimensions: Sequence[str] = DIMENSIONS,
    bits: int = BITS,
) -> DataFrame:
    """Every document's shard and place in it.

    The dimensions that the table has are cut into 2**bits cells at quantiles of the whole table;
    documents are sorted by the Hilbert index of their cell and cut into ``shards`` runs, so that a
    shard's files cover a small box of all dimensions at once and min/max statistics prune on any of
    them. Rows with equal texts stand together, at the cell of the one with the smallest doc_id, and
    are parted only where a run ends. ``law`` is ``rows`` (counts at most one apart) or ``bytes``
    (a run ends where its share of all bytes does, to within one document).

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law, shard (0-based), slot
    (place in the shard, gapless from 0) and cell. A null text counts no bytes and equals an empty
    one; null dimensions sort first; rows without doc_id or with a repeated one are rows like any
    other. With fewer rows than shards some shards have none; an empty table gives an empty table.
    Only narrow rows are sorted, never texts.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law must be rows or bytes")
    have = [d for d in dimensions if d in documents.columns]
    text = F.encode(text_of(), "UTF-8")
    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("same"),
        *[_ordered(documents, d).alias(f"dim{i}") for i, d in enumerate(have)],
    )
    dims = [f"dim{i}" for i in range(len(have))]
    narrow = stored(narrow)
    cells = quantised(narrow, dims, bits) or [F.lit(0)]

    @pandas_udf("long")
    def on_curve(points: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index([points[c].to_numpy() for c in points.columns], bits))

    # A group of copies enters the shuffle once per task and its rows are joined back by their text.
    names = [f"c{i}" for i in range(len(cells))]
    boxes = narrow.select("same", "doc_id", *[c.alias(n) for c, n in zip(cells, names)])
    lead = boxes.groupBy("same").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *names)).alias("lead")
    ).select("same", *[F.col(f"lead.{n}").alias(n) for n in names])
    lead = stored(lead.select("same", on_curve(F.struct(*names)).alias("cell")))
    placed = positions(
        narrow.select("doc_id", "size", "text_crc32", "same").join(lead, "same"),
        [F.col("cell"), F.col("same"), F.col("doc_id")],
    )
    if law == "rows":
        rows = placed.count()
        number = F.expr(f"position * {shards} div {max(rows, 1)}")
    else:
        placed, number = _by_bytes(placed, shards)
    cut = placed.withColumn("shard", number.cast("int"))
    # One row a shard.
    first = cut.groupBy("shard").agg(F.min("position").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard",
        (F.col("position") - F.col("first")).alias("slot"), "cell",
    )


def _by_bytes(placed: DataFrame, shards: int) -> tuple[DataFrame, Column]:
    """Rows with the bytes before them, by way of sums over blocks of 4096 neighbours."""
    from pyspark.sql import Window

    block = F.shiftright("position", 12)
    sums = placed.groupBy(block.alias("block")).agg(F.sum("size").alias("bytes"))
    wide = sums.withColumn("wide", F.shiftright("block", 12))
    tops = wide.groupBy("wide").agg(F.sum("bytes").alias("bytes"))
    # One row for 16 million documents: a window of one task.
    tops = tops.select("wide", (F.sum("bytes").over(Window.orderBy("wide")) - F.col("bytes")).alias("over"))
    within = F.sum("bytes").over(Window.partitionBy("wide").orderBy("block")) - F.col("bytes")
    blocks = wide.withColumn("within", within).join(tops, "wide")
    blocks = blocks.select("block", (F.col("within") + F.col("over")).alias("before"))
    total = placed.agg(F.sum("size")).head()[0] or 1
    near = F.sum("size").over(Window.partitionBy("block").orderBy("position")) - F.col("size")
    out = placed.withColumn("block", block).withColumn("near", near).join(blocks, "block")
    middle = F.col("before") + F.col("near") + F.col("size") / 2
    return out, F.least(F.floor(middle * shards / total), F.lit(shards - 1))


def write_shards(documents: DataFrame, placed: DataFrame, path: str) -> None:
    """Documents as Parquet, a folder per shard, rows in slot order. doc_id must be unique."""
    rows = documents.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
