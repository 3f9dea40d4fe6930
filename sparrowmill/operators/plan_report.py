"""Physical-plan reports: what a query really ran, as rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

# Nodes that only wrap another one, and those that run it elsewhere.
WRAPPERS = ("WholeStageCodegen", "InputAdapter", "AdaptiveSparkPlan", "ColumnarToRow")
STAGES = ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage", "TableCacheQueryStage")


@dataclass(frozen=True)
class Step:
    """One operator of the final plan. ``rows`` is what it put out (-1 where it is not counted)."""

    depth: int
    operator: str
    table: str
    columns: int
    pushed: str
    skewed: bool
    rows: int


def _sequence(items: JavaObject) -> list[JavaObject]:
    return [items.apply(i) for i in range(items.size())]


def _metadata(node: JavaObject, key: str) -> str:
    found = node.metadata().get(key)
    return found.get() if found.isDefined() else ""


def _rows(node: JavaObject) -> int:
    metric = node.metrics().get("numOutputRows")
    return metric.get().value() if metric.isDefined() else -1


def _walk(node: JavaObject, depth: int) -> Iterator[Step]:
    kind = node.getClass().getSimpleName().removesuffix("Exec")
    if kind == "AdaptiveSparkPlan":
        yield from _walk(node.executedPlan(), depth)
    elif kind in STAGES:
        yield from _walk(node.plan(), depth)
    elif kind in WRAPPERS:
        yield from _walk(node.child(), depth)
    elif kind == "ReusedExchange":
        yield Step(depth, kind, "", 0, "", False, -1)
    else:
        table, pushed = "", ""
        if kind == "FileSourceScan":
            place = _metadata(node, "Location").rsplit("/", 1)[-1]
            table, pushed = place.rstrip("]").removesuffix(".parquet"), _metadata(node, "PushedFilters")
        skewed = kind == "AQEShuffleRead" and bool(node.hasSkewedPartition())
        yield Step(depth, kind, table, node.output().size(), pushed, skewed, _rows(node))
        for child in _sequence(node.children()):
            yield from _walk(child, depth + 1)
        for inner in _sequence(node.subqueries()):
            yield from _walk(inner.child(), depth + 1)


def plan_steps(df: DataFrame, run: bool = True) -> list[Step]:
    """The operators of ``df``'s plan, top first. With ``run`` it is executed, so that the plan is the one
    that adaptive execution ended with and rows are counted; without, it is the plan before that."""
    execution = df._jdf.queryExecution()
    if run:
        execution.toRdd().count()
    return list(_walk(execution.executedPlan(), 0))


def plan_report(spark: SparkSession, queries: Mapping[str, DataFrame], run: bool = True) -> DataFrame:
    """A row per operator of each query's plan: query, step (from the top), depth, operator, table,
    columns, pushed (filters that the scan got), skewed (a skewed partition was split), rows."""
    rows = [
        (name, i, s.depth, s.operator, s.table, s.columns, s.pushed, s.skewed, s.rows)
        for name, df in queries.items() for i, s in enumerate(plan_steps(df, run))
    ]
    return spark.createDataFrame(
        rows, "query string, step int, depth int, operator string, table string, columns int, pushed string, "
        "skewed boolean, rows long",
    )


def kind(operator: str) -> str:
    """scan, exchange, join, aggregate, sort, window, or other."""
    for name, part in (("scan", "Scan"), ("exchange", "Exchange"), ("join", "Join"), ("join", "CartesianProduct"),
                       ("aggregate", "Aggregate"), ("window", "Window"), ("sort", "Sort")):
        if part in operator:
            return "reused exchange" if operator == "ReusedExchange" else name
    return "other"


def counts(steps: list[Step]) -> dict[str, int]:
    """Number of operators of each kind."""
    found: dict[str, int] = {}
    for step in steps:
        found[kind(step.operator)] = found.get(kind(step.operator), 0) + 1
    return found
