"""What the operators share: stored intermediate tables, batches of texts, tables merged by slab."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.sources.files import shared_folder

# Python works on at most this many bytes of text at a time, or on one text if that is longer.
CHUNK_CHARS = 500_000


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and with no lineage that
    a lost executor could force back to the start."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches again, cut between rows so that each holds about CHUNK_CHARS bytes of text."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + (size or 0) > CHUNK_CHARS:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)


# Parts of a slab meet in groups of so many tasks at each level before the last.
LEVELS = (16, 256, 4096)


def merge_slabs(rows: DataFrame, merge: Callable[[bytes, bytes], bytes]) -> dict[int, bytes]:
    """A table cut into slabs, merged over all tasks: rows are (slab int, part binary).

    ``merge`` must be associative and commutative. A task gives each slab once; the parts of a slab
    then meet sorted, so that two of them at a time are in memory: first those of 16 tasks, then of 256,
    then of 4,096, so that a merging task reads 16 parts, or one for 4,096 tasks in the last level. The
    caller bounds number and size of the slabs, and so the result.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, held = None, b""
        for batch in batches:
            for number, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number == slab:
                    held = merge(held, part.as_py())
                    continue
                if slab is not None:
                    yield _slab_row(slab, held)
                slab, held = number, part.as_py()
        if slab is not None:
            yield _slab_row(slab, held)

    rows = rows.withColumn("task", F.spark_partition_id())
    for width in LEVELS:
        group = F.floor(F.col("task") / F.lit(width)).cast("int")
        dealt = rows.withColumn("group", group).repartition("slab", "group").sortWithinPartitions("group", "slab")
        rows = dealt.select("group", "slab", "part").mapInArrow(
            lambda batches, width=width: _grouped(fold, width, batches), "slab int, part binary, task int"
        )
    dealt = rows.select("slab", "part").repartition("slab").sortWithinPartitions("slab")
    return {r[0]: bytes(r[1]) for r in dealt.mapInArrow(fold, "slab int, part binary").collect()}


def _grouped(fold, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (group, slab, part), sorted, folded per slab of each group; a group goes on as the task
    number that it begins with."""
    for group, run in groupby(_rows_by_group(batches), key=lambda b: b[0]):
        for merged in fold(b for _, b in run):
            yield pa.RecordBatch.from_arrays(
                [*merged.columns, pa.array([group * width] * merged.num_rows, pa.int32())], ["slab", "part", "task"]
            )


def _rows_by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        groups = batch.column(0).to_pylist()
        start = 0
        for i in range(1, len(groups) + 1):
            if i == len(groups) or groups[i] != groups[start]:
                yield groups[start], batch.select(["slab", "part"]).slice(start, i - start)
                start = i


def _slab_row(slab: int, part: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([part])], ["slab", "part"])


def positions(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted, with ``position`` counting from 0 over the whole table without gaps.

    A range sort over all executors; a part's offset is the number of rows in the parts before it,
    of which there is one small row per part. Stored, since positions must not change on a retry.
    """
    in_part = F.monotonically_increasing_id()
    cut = stored(
        df.orderBy(*order).withColumns(
            {"__part": F.shiftright(in_part, 33), "__row": in_part.bitwiseAND((1 << 33) - 1)}
        )
    )
    counts = cut.groupBy("__part").count().collect()
    offsets, total = [], 0
    for part, rows in sorted(counts):
        offsets.append((part, total))
        total += rows
    parts = df.sparkSession.createDataFrame(offsets, "__part long, __offset long")
    # One row per sorted partition of the table: the number of tasks bounds the broadcast.
    return (
        cut.join(F.broadcast(parts), "__part")
        .withColumn("position", F.col("__offset") + F.col("__row"))
        .drop("__part", "__row", "__offset")
    )


def total(df: DataFrame, value: Column) -> int:
    return int(df.agg(F.sum(value)).head()[0] or 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Groups of neighbouring rows that agree in the first ``keys`` columns, one batch each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        new[0] = first != last
        last = tuple(c[-1] for c in columns)
        start = 0
        for cut in [*np.flatnonzero(new).tolist(), batch.num_rows]:
            if cut > start:
                held.append(batch.slice(start, cut - start))
            if cut < batch.num_rows and held:
                yield _joined(held)
                held = []
            start = cut
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
