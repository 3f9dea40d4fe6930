"""Sorted ranges: a table sorted once over all executors, and what its ranges tell each other.

A range is one partition of a global sort. It is cut by the sort order alone, so a key that holds a
large share of the rows spans several ranges and no task gets more than its share. Work that runs along
the order is done inside each range; one small row per range then carries over what the ranges before
it (or behind it) add.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparrowmill.sources.files import shared_folder

PART, INDEX, GUEST = "__part", "__index", "__guest"


@dataclass(frozen=True)
class Ranges:
    """Sorted rows with their range (``__part``) and place in it (``__index``), and the ranges' lengths."""

    rows: DataFrame
    lengths: tuple[int, ...]

    def dealt(self, rows: DataFrame | None = None) -> DataFrame:
        """The rows, or ``rows`` with ranges of these, one task per range: windows over (range, key) need
        no further shuffle."""
        rows = self.rows if rows is None else rows
        return rows.repartitionById(max(len(self.lengths), 1), F.col(PART))

    def with_guests(self, back: int, ahead: int) -> DataFrame:
        """The rows, and in each range as guests the ``back`` rows before its first one and the ``ahead``
        rows after its last one, whichever ranges they are in. Guests have ``__guest`` set.

        Which rows those are follows from the lengths: ``back`` + ``ahead`` places per range.
        """
        starts = list(accumulate(self.lengths, initial=0))
        wanted = []
        for host, length in enumerate(self.lengths):
            if length:
                first, after = starts[host], starts[host + 1]
                places = [*range(max(0, first - back), first), *range(after, min(after + ahead, starts[-1]))]
                wanted += [(host, *self._at(starts, place)) for place in places]
        listed = self.rows.sparkSession.createDataFrame(wanted, f"__host int, {PART} int, {INDEX} long")
        guests = self.rows.join(F.broadcast(listed), [PART, INDEX])
        guests = guests.withColumns({PART: F.col("__host"), GUEST: F.lit(True)})
        hosts = self.rows.withColumn(GUEST, F.lit(False))
        return hosts.unionByName(guests.select(*hosts.columns))

    @staticmethod
    def _at(starts: list[int], place: int) -> tuple[int, int]:
        """(range, place in it) of a row by its place in the whole order."""
        part = bisect_right(starts, place) - 1
        return part, place - starts[part]


def sorted_ranges(df: DataFrame, order: Sequence[Column]) -> Ranges:
    """``df`` sorted over all executors and stored.

    The input is read once. It is stored because ranges are cut by a sample: a plan that computed them
    twice could cut them differently. One small row per range comes back.
    """
    spark = df.sparkSession
    at = F.monotonically_increasing_id()
    cut = df.orderBy(*order).withColumns(
        {PART: F.shiftright(at, 33).cast("int"), INDEX: at.bitwiseAND((1 << 33) - 1)}
    )
    path = shared_folder(spark)
    cut.write.parquet(path)
    rows = spark.read.schema(cut.schema).parquet(path)
    counted = dict(map(tuple, rows.groupBy(PART).agg(F.count(F.lit(1))).collect()))
    return Ranges(rows, tuple(counted.get(i, 0) for i in range(max(counted, default=-1) + 1)))
