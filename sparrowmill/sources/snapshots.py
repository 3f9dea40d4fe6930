"""Versioned datasets: one partition per snapshot, read as of any of them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession, path: str):
    """(path, file system, partition name utilities) of the cluster's storage layer."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return location, fs, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def _folder(spark: SparkSession, path: str, snapshot_col: str, snapshot: str) -> str:
    return f"{path}/{snapshot_col}={_hadoop(spark, path)[2].escapePathName(snapshot)}"


def write_snapshot(
    df: DataFrame,
    path: str,
    snapshot_col: str,
    snapshot: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Add one snapshot, or replace the same one; the other snapshots stay untouched.

    Each snapshot may have its own columns; the reader merges them.
    """
    (
        df.withColumn(snapshot_col, F.lit(snapshot))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(snapshot_col, *partition_by)
        .parquet(path)
    )


def write_checked_snapshot(
    df: DataFrame,
    path: str,
    snapshot_col: str,
    snapshot: str,
    check: Callable[[DataFrame], None],
    partition_by: Sequence[str] = (),
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write the rows out of readers' sight, check what was written, then show it as the snapshot.

    The rows are computed once, and those checked are those published even where the source has
    moved on. ``watch`` may add observations to the rows as they are written, for ``check`` to read. When ``check`` raises no reader ever sees them; they stay aside for inspection until
    ``clear_aside``. A snapshot that is replaced is moved aside first and deleted last, so that no
    failure in between loses it; between the two renames a reader of that one snapshot finds none.
    """
    spark = df.sparkSession
    aside = f"{path}/_unchecked-{uuid.uuid4().hex}"
    (watch(df) if watch else df).write.partitionBy(*partition_by).parquet(aside)
    check(spark.read.parquet(aside))
    final, fs, _ = _hadoop(spark, _folder(spark, path, snapshot_col, snapshot))
    replaced = _hadoop(spark, f"{path}/_replaced-{uuid.uuid4().hex}")[0] if fs.exists(final) else None
    if replaced is not None and not fs.rename(final, replaced):
        raise OSError(f"could not move {final.toString()} aside")
    if not fs.rename(_hadoop(spark, aside)[0], final):
        if replaced is not None:
            fs.rename(replaced, final)
        raise OSError(f"could not publish {aside} as {final.toString()}")
    if replaced is not None:
        fs.delete(replaced, True)


def clear_aside(spark: SparkSession, path: str) -> int:
    """Delete what failed checks and broken replacements left aside; the number of folders."""
    root, fs, _ = _hadoop(spark, path)
    found = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
    aside = [p for p in found if p.getName().startswith(("_unchecked-", "_replaced-"))]
    for folder in aside:
        fs.delete(folder, True)
    return len(aside)


def list_snapshots(
    spark: SparkSession, path: str, snapshot_col: str, kind: Callable[[str], object] = str
) -> list[str]:
    """Snapshot values in order, from the folder names; no data is read.

    ``kind`` makes a value comparable: ``int`` for numbered versions, as text "10" is before "9".
    """
    root, fs, names = _hadoop(spark, path)
    if not fs.exists(root):
        return []
    prefix = f"{snapshot_col}="
    folders = [status.getPath().getName() for status in fs.listStatus(root)]
    found = [names.unescapePathName(f[len(prefix) :]) for f in folders if f.startswith(prefix)]
    return sorted(found, key=kind)


def read_all(spark: SparkSession, path: str, snapshot_col: str) -> DataFrame:
    """Every snapshot; columns that came or went are null where they are missing.

    Snapshot values keep their text: partition type inference, which would read "01" as 1, is off
    while the folders are listed. Other partition columns come as text too.
    """
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    finally:
        spark.conf.set(name, before)


def read_snapshot(
    spark: SparkSession,
    path: str,
    snapshot_col: str,
    at: str | None = None,
    kind: Callable[[str], object] = str,
    **partition_values,
) -> DataFrame:
    """The latest snapshot, or the latest not after ``at``, with that snapshot's own columns.

    Only the chosen snapshot's folder is read. ``partition_values`` filter further partitions.
    """
    every = list_snapshots(spark, path, snapshot_col, kind)
    known = [s for s in every if at is None or kind(s) <= kind(at)]
    if not known:
        raise ValueError(f"no snapshot at or before {at} under {path}")
    frame = spark.read.parquet(_folder(spark, path, snapshot_col, known[-1]))
    frame = frame.withColumn(snapshot_col, F.lit(known[-1]))
    for column, value in partition_values.items():
        frame = frame.filter(F.col(column) == F.lit(value))
    return frame


def snapshot_history(df: DataFrame, snapshot_col: str, *bounds: str) -> DataFrame:
    """Rows per snapshot, with the lowest and highest value of each named column."""
    ranges = [f(c).alias(f"{p}_{c}") for c in bounds for p, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(snapshot_col).agg(F.count(F.lit(1)).alias("rows"), *ranges)
