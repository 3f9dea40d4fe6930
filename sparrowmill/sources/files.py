"""File sources and sinks, and the shared folder for data a job parks between steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Nothing between two separators is null, two quotes are empty text. Spark's reader takes both for
# null unless null has a value of its own, which no text may be.
NO_TEXT = "\0"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "|", escape: str = '"',
    line_breaks: bool = False, escaped_breaks: bool = False,
) -> DataFrame:
    """Delimited text without a header into a typed table; a trailing separator is ignored.

    ``line_breaks`` and ``escaped_breaks`` as in ``read_csv``.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("nullValue", NO_TEXT)
    rows = reader.option("escape", escape).option("multiLine", line_breaks).csv(path)
    return restored_breaks(rows) if escaped_breaks else rows


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    line_breaks: bool = False, escaped_breaks: bool = False,
) -> DataFrame:
    """CSV without a header; columns are text (_c0, _c1, ...) unless a schema types them.

    Texts with line breaks need ``line_breaks``, which reads each file whole, in one task, or files
    that were written with ``escape_breaks``, which ``escaped_breaks`` reads in splits.
    """
    reader = spark.read.option("nullValue", NO_TEXT).option("escape", '"').option("multiLine", line_breaks)
    rows = (reader.schema(schema) if schema is not None else reader).csv(path)
    return restored_breaks(rows) if escaped_breaks else rows


def text_format(sep: str = ",", line_breaks: bool = False, rows_per_file: int = 1_000_000) -> dict[str, str]:
    """The options of a text table that reads what was inserted: null by a mark of its own, empty text
    quoted, quotes doubled, spaces kept.

    With ``line_breaks`` texts may have them; a file is then read by one task, so files are kept short.
    """
    spaces = {f"ignore{side}WhiteSpace": "false" for side in ("Leading", "Trailing")}
    short = {"maxRecordsPerFile": str(rows_per_file)} if line_breaks else {}
    return {
        "sep": sep, "quote": '"', "escape": '"', "nullValue": NO_TEXT, "multiLine": str(line_breaks).lower(),
        "header": "false", **spaces, **short,
    }


def without_mark(df: DataFrame) -> DataFrame:
    """``df``, failing the job where a text is the mark that stands for null in text files."""
    refused = F.raise_error(F.lit("a text of one NUL character cannot be told from null in a text file"))
    return _texts(df, lambda c: F.when(c == NO_TEXT, refused.cast("string")).otherwise(c))


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(*[
        change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def escaped_breaks_of(df: DataFrame) -> DataFrame:
    """Line breaks in texts as \\n and \\r, backslashes doubled."""
    return _texts(df, lambda c: F.replace(
        F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")))


def restored_breaks(df: DataFrame) -> DataFrame:
    """The reverse. Between doubled backslashes, read from the left, a backslash opens a break."""
    def part(text: Column) -> Column:
        return F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    pair = r"\\\\"  # as a pattern: two backslashes
    return _texts(df, lambda c: F.array_join(F.transform(F.split(c, pair, -1), part), "\\"))


def write_csv(
    df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists", escape_breaks: bool = False
) -> None:
    """Separated text that ``read_csv`` and ``read_delimited`` give back as it was: spaces stay,
    quotes are doubled, empty text is quoted and null is not. ``escape_breaks`` keeps a row in one
    line, so that large files stay splittable."""
    df = without_mark(df)
    df = escaped_breaks_of(df) if escape_breaks else df
    writer = df.write.mode(mode).option("sep", sep).option("escape", '"').option("emptyValue", '""')
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, "false")
    writer.csv(path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the cluster's storage and all in it; whether there was one."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(location, True))


# The folders named so far in this driver.
_PARKED: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sparrowmill-")
    _PARKED.append(f"{base.rstrip('/')}/sparrowmill-{uuid.uuid4().hex}")
    return _PARKED[-1]


def clear_shared_folders(spark: SparkSession) -> int:
    """Delete every folder that ``shared_folder`` has named in this driver; the number of folders found.

    For the caller to use when the results that read them are no longer needed.
    """
    found = sum(delete_folder(spark, path) for path in _PARKED)
    _PARKED.clear()
    return found
