"""Storage layout: partitioned, bucketed and sorted writes, and reads that profit from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.operators.joins import estimated_bytes
from sparrowmill.sources.files import delete_folder

FILE_ROWS = 20_000_000
LEAST_BUCKETS = 8


def write_partitioned(
    df: DataFrame, path: str, partition: dict[str, Column], mode: str = "overwrite",
    file_rows: int = FILE_ROWS,
) -> None:
    """Parquet partitioned by derived columns, e.g. the year of a date.

    No shuffle by the partition value: one value may hold most rows, and each task can write its
    own files. Adaptive rebalancing evens the files out and splits the large values.
    """
    names = list(partition)
    (
        df.withColumns(partition)
        .hint("rebalance", *[F.col(c) for c in names])
        .write.mode(mode)
        .option("maxRecordsPerFile", file_rows)
        .partitionBy(*names)
        .parquet(path)
    )


def write_sorted(
    df: DataFrame, path: str, order: Sequence[str], partitions: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Range-partitioned and sorted files: similar values sit together and compress better.

    The sampled ranges split on the sort columns; name a unique last column where one value of
    the first may fill many files.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    ordered = [F.col(c).asc_nulls_first() for c in order]
    ranged.sortWithinPartitions(*ordered).write.mode(mode).parquet(path)


SLICE = "bucket_slice"


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table, and whether its buckets came out even enough to scan one per task.

    With ``slices`` above one the keys alone are too few for the data: buckets are then cut by the key
    and the column ``bucket_slice``, so a key's rows lie in several buckets.
    """

    table: str
    path: str
    even: bool
    buckets: int
    slices: int = 1

    def read(self, spark: SparkSession) -> DataFrame:
        """Through the catalog. Equal keys share a bucket and need no shuffle; in a sliced table equal
        (key, slice) do, and a grouping by key merges one row per key and slice."""
        return spark.table(self.table).drop(SLICE)

    def read_files(self, spark: SparkSession) -> DataFrame:
        """As plain files, split by size. A bucket is scanned by one task, so this is the better
        read of a table with a hot bucket (``even`` is false)."""
        return spark.read.parquet(self.path).drop(SLICE)

    def drop(self, spark: SparkSession) -> None:
        """Remove the table and its files."""
        spark.sql(f"DROP TABLE IF EXISTS `{self.table}`")
        delete_folder(spark, self.path)


def buckets_for(df: DataFrame, bucket_bytes: int = 512 << 20, least: int = LEAST_BUCKETS) -> int:
    return max(least, -(-estimated_bytes(df) // bucket_bytes))


def slices_for(df: DataFrame, by: Sequence[str], buckets: int) -> int:
    """Into how many parts each key's rows must be cut for ``buckets`` buckets to fill: 1 where there are
    as many keys. The keys are counted by a sketch, in one pass over their columns."""
    keys = df.agg(F.approx_count_distinct(F.struct(*by))).head()[0]
    return 1 if keys >= buckets else -(-buckets // max(keys, 1))


def write_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    by: Sequence[str],
    buckets: int | None = None,
    sort: Sequence[str] = (),
    uneven: float = 4.0,
    mode: str = "overwrite",
    slices: int = 1,
) -> Bucketed:
    """Write a bucketed table (sorted within buckets when ``sort`` is given).

    The bucket count follows the input's size, unless it is given. Where that is more than the least
    count and there are fewer keys than buckets, a hash of the whole row joins the key (as with
    ``slices`` above one), so that no bucket must hold all of one key. Rows are rebalanced by bucket first, so a task writes few buckets and a large bucket is
    written by several tasks. The largest bucket is compared with the mean (one row comes back) to tell
    callers how evenly the table reads.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = buckets_for(df)
        slices = slices_for(df, by, buckets) if buckets > LEAST_BUCKETS else slices
    keys = list(by)
    if slices > 1:
        df = df.withColumn(SLICE, F.pmod(F.xxhash64(*df.columns), F.lit(slices)).cast("int"))
        keys.append(SLICE)
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    gathered = df.withColumn("__bucket", bucket).hint("rebalance", F.col("__bucket"))
    writer = (
        gathered.drop("__bucket")
        .write.mode(mode)
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
    )
    if sort:
        writer = writer.sortBy(*sort)
    writer.saveAsTable(table)
    loads = (
        spark.read.parquet(path)
        .groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max("n").alias("top"), F.sum("n").alias("total"))
        .first()
    )
    even = not loads["total"] or loads["top"] <= uneven * loads["total"] / buckets
    return Bucketed(table, path, even, buckets, slices)


def write_sized(df: DataFrame, path: str, rows_per_file: int = FILE_ROWS, mode: str = "overwrite"):
    """Even output files: adaptive execution merges and splits partitions before the write."""
    df.hint("rebalance").write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def dataset_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path, from file metadata."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(location).getLength())
