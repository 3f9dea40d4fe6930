"""Data-quality suites, key checks and the gate that stops a bad dataset."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

KINDS = ("unique", "max_between", "not_null", "matches_strftime", "between")

# Strftime directives and the matching Spark date pattern letters.
STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


class InvalidData(Exception):
    """A dataset failed its suite."""


@dataclass(frozen=True)
class Expectation:
    """kind and column, with min_value, max_value, strict_min, strict_max or format as needed."""

    kind: str
    column: str
    options: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown expectation {self.kind}")
        if self.kind == "matches_strftime":
            date_pattern(str(self.options["format"]))


def _out_of_bounds(value: Column, options: Mapping[str, object]) -> Column:
    low, high = options.get("min_value"), options.get("max_value")
    out = F.lit(False)
    if low is not None:
        out = out | ((value <= low) if options.get("strict_min") else (value < low))
    if high is not None:
        out = out | ((value >= high) if options.get("strict_max") else (value > high))
    return out


def date_pattern(strftime: str) -> str:
    """The Spark date pattern of a strftime format: directives by the table, the rest quoted."""
    parts = re.findall(r"%.?|[^%]+", strftime, re.S)
    unknown = [p for p in parts if p.startswith("%") and p not in STRFTIME]
    if unknown:
        raise ValueError(f"unknown directives {unknown} in {strftime}")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return "".join(STRFTIME.get(p, q) for p, q in zip(parts, quoted))


def _parses(column: str, strftime: str) -> Column:
    pattern = date_pattern(strftime)
    return F.try_to_timestamp(F.col(column).cast("string"), F.lit(pattern)).isNotNull()


def _measures(suite: Sequence[Expectation]) -> dict[str, Column]:
    """``seen<i>`` and ``bad<i>`` of every check that one pass of aggregates answers."""
    found: dict[str, Column] = {}
    for i, e in enumerate(suite):
        value = F.col(e.column)
        if e.kind == "unique":
            continue
        seen, bad = F.count(value), F.count_if(_out_of_bounds(value, e.options))
        if e.kind == "max_between":
            seen = F.max(value)
            # Without values there is no maximum, which meets no bound.
            bad = F.when(_out_of_bounds(seen, e.options) | seen.isNull(), 1).otherwise(0)
        elif e.kind == "not_null":
            bad = F.count_if(value.isNull())
        elif e.kind == "matches_strftime":
            bad = F.count_if(value.isNotNull() & ~_parses(e.column, str(e.options["format"])))
        found[f"seen{i}"] = seen.cast("double")
        found[f"bad{i}"] = F.coalesce(bad.cast("long"), F.lit(0).cast("long"))
    return found


def _copies(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame | None:
    """seen and bad of every uniqueness check, by position: each row is expanded into one (position,
    value) per column checked, and all of them are counted in one shuffle, combined map-side."""
    checked = {i: e.column for i, e in enumerate(suite) if e.kind == "unique"}
    if not checked:
        return None
    values = [
        F.struct(F.lit(i).alias("position"), F.col(c).cast("string").alias("value")) for i, c in checked.items()
    ]
    counts = df.select(F.inline(F.array(*values))).where("value IS NOT NULL").groupBy("position", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.groupBy("position").agg(
        F.count(F.lit(1)).cast("double").alias("seen"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("bad"),
    )


def evaluate(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: position, expectation, column, observed, unexpected, success.

    Two passes at most, however many checks: one of aggregates, and one that counts the values of all
    columns that must be unique.
    """
    kinds = [(i, e.kind, e.column) for i, e in enumerate(suite)]
    listed = df.sparkSession.createDataFrame(kinds, "position int, expectation string, column string")
    parts = []
    measures = _measures(suite)
    if measures:
        wide = df.agg(*[m.alias(name) for name, m in measures.items()])
        rows = [
            F.struct(F.lit(i).alias("position"), F.col(f"seen{i}").alias("seen"), F.col(f"bad{i}").alias("bad"))
            for i, e in enumerate(suite) if e.kind != "unique"
        ]
        parts.append(wide.select(F.inline(F.array(*rows))))
    copies = _copies(df, suite)
    if copies is not None:
        parts.append(copies)
    found = F.broadcast(reduce(DataFrame.unionByName, parts))  # a row per expectation
    bad = F.coalesce(F.col("bad"), F.lit(0))
    seen = F.when(F.col("expectation") == "unique", F.coalesce("seen", F.lit(0.0))).otherwise(F.col("seen"))
    return listed.join(found, "position", "left").select(
        "position", "expectation", "column", seen.alias("observed"), bad.alias("unexpected"),
        (bad == 0).alias("success"),
    )


class Gate:
    """A suite checked on rows while they are computed.

    ``watch`` gives the rows with the suite's aggregates observed on the way, to whatever job computes
    them; ``verdict`` then raises ``InvalidData`` on failure. Only what must be unique is counted in a
    pass of its own, which reads those columns alone.
    """

    def __init__(self, suite: Sequence[Expectation], name: str = "dataset"):
        self.suite, self.name = list(suite), name
        self.observed: Observation | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        measures = _measures(self.suite)
        if not measures:
            return df
        self.observed = Observation()
        return df.observe(self.observed, *[m.alias(name) for name, m in measures.items()])

    def verdict(self, written: DataFrame) -> None:
        """Raise if the watched rows, which ``written`` holds now, fail a check."""
        copies = _copies(written, self.suite)
        self._judge([] if copies is None else copies.collect())

    def _judge(self, copies: Sequence[Row]) -> None:
        seen = self.observed.get if self.observed else {}
        bad = {r["position"]: r["bad"] for r in copies}
        bad |= {i: seen[f"bad{i}"] for i in range(len(self.suite)) if f"bad{i}" in seen}
        failed = [(e, bad[i]) for i, e in enumerate(self.suite) if bad.get(i)]
        if failed:
            reasons = ", ".join(f"{e.kind}({e.column}): {n} unexpected" for e, n in failed)
            raise InvalidData(f"{self.name} did not pass validation: {reasons}")

    def enforce(self, df: DataFrame) -> None:
        """The same for rows that nothing else computes: one query over one reading of ``df``."""
        copies = _copies(self.watch(df), self.suite)
        if copies is not None:
            self._judge(copies.collect())
        elif self.suite:
            failed = [r for r in evaluate(df, self.suite).collect() if not r["success"]]
            self.observed = None
            self._judge([Row(position=r["position"], bad=r["unexpected"]) for r in failed])


def enforce(df: DataFrame, suite: Sequence[Expectation], name: str = "dataset") -> None:
    """Run the suite and raise ``InvalidData`` on failure; a few values come back."""
    Gate(suite, name).enforce(df)


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def fk_violations(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]
) -> DataFrame:
    """Child key values without a parent, with their row count; null keys refer to nothing.

    The child shrinks to one row per key before the join, so a hot key cannot skew it.
    """
    counted = child.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("orphans"))
    for key in child_keys:
        counted = counted.filter(F.col(key).isNotNull())
    known = parent.select(*parent_keys).distinct()
    on = reduce(
        lambda a, b: a & b, [counted[c] == known[p] for c, p in zip(child_keys, parent_keys)]
    )
    return counted.join(known, on, "left_anti")
