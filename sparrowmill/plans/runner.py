"""Runs a set of table nodes in dependency order, each once, under one run time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from sparrowmill.operators.quality import Expectation, Gate, enforce
from sparrowmill.plans import gold, silver
from sparrowmill.plans.bronze import BRONZE, STAMP, bronze, stamp
from sparrowmill.sources.snapshots import read_snapshot, write_checked_snapshot, write_snapshot


@dataclass(frozen=True)
class Node:
    """A table: what it is built from, how, and its key. A node with ``source`` reads upstream."""

    name: str
    keys: tuple[str, ...]
    upstream: tuple[str, ...] = ()
    build: Callable[..., DataFrame] | None = None
    source: str | None = None


@dataclass(frozen=True)
class Dataset:
    """A node's result and where it is kept."""

    name: str
    df: DataFrame
    keys: tuple[str, ...]
    path: str | None = None
    fmt: str = "parquet"
    partition_keys: tuple[str, ...] = (STAMP,)


# Quality suites by node name.
SUITES: dict[str, tuple[Expectation, ...]] = {
    "orders": (Expectation("unique", "order_id"),),
    "fact_orders": (Expectation("unique", "order_id"),),
    "daily_order_metrics": (
        Expectation("unique", "order_date"),
        Expectation(
            "max_between", "total_price_mean",
            {"min_value": 0, "max_value": 100_000, "strict_max": True},
        ),
    ),
}

NODES: tuple[Node, ...] = (
    *[Node(spec.name, spec.keys, source=spec.source) for spec in BRONZE.values()],
    Node("dim_buyer", ("user_id",), ("user", "buyer"), silver.dim_buyer),
    Node("dim_seller", ("user_id",), ("user", "seller"), silver.dim_seller),
    Node("dim_product", ("product_id",), ("product", "brand", "manufacturer"), silver.dim_product),
    Node("dim_category", ("category_id",), ("category",), silver.dim_category),
    Node("fact_order_items", ("order_item_id",), ("order_item",), silver.fact_order_items),
    Node("fact_orders", ("order_id",), ("orders",), silver.fact_orders),
    Node("product_x_category", ("product_id", "category_id"), ("product_category",),
         silver.product_x_category),
    Node("seller_x_product", ("seller_id", "product_id"), ("seller_product",),
         silver.seller_x_product),
    Node("wide_orders", ("order_id",), ("fact_orders", "dim_seller"), gold.wide_orders),
    Node("wide_order_items", ("order_item_id",),
         ("fact_order_items", "dim_product", "dim_seller", "product_x_category", "dim_category"),
         gold.wide_order_items),
    Node("daily_order_metrics", ("order_date",), ("wide_orders",), gold.daily_order_metrics),
    Node("daily_category_metrics", ("order_date", "category"), ("wide_order_items",),
         gold.daily_category_metrics),
)


class Pipeline:
    """Nodes by name. ``run`` builds the targets and all they need."""

    def __init__(
        self,
        nodes: Sequence[Node] = NODES,
        suites: Mapping[str, Sequence[Expectation]] = SUITES,
    ):
        self.nodes = {node.name: node for node in nodes}
        self.suites = dict(suites)
        for node in nodes:
            missing = set(node.upstream) - set(self.nodes)
            if missing:
                raise ValueError(f"{node.name} needs unknown nodes {sorted(missing)}")

    def order(self, targets: Sequence[str]) -> list[str]:
        """The targets and everything upstream of them, upstream first, each once."""
        needed: dict[str, tuple[str, ...]] = {}
        waiting = list(targets)
        while waiting:
            name = waiting.pop()
            if name not in needed:
                needed[name] = self.nodes[name].upstream
                waiting.extend(needed[name])
        return list(TopologicalSorter(needed).static_order())

    def run(
        self,
        spark: SparkSession,
        targets: Sequence[str],
        sources: Callable[[str], DataFrame],
        run_ts: str,
        path: str | None = None,
        validate: bool = True,
    ) -> dict[str, Dataset]:
        """Build, check and, with a ``path``, write each table as this run's snapshot.

        A stored table is computed once: its suite is observed while the rows are written, and what
        must be unique is counted on the written rows before they are shown.
        Without a path tables are handed on as lazy plans and Catalyst sees through all layers.
        ``sources`` gives the upstream table of a name. A failing suite raises ``InvalidData``.
        """
        done: dict[str, Dataset] = {}
        for name in self.order(targets):
            node = self.nodes[name]
            if node.source is not None:
                frame = bronze(BRONZE[name], sources(node.source), run_ts)
            else:
                frame = stamp(node.build(*[done[u].df for u in node.upstream]), run_ts)
            unknown = set(node.keys) - set(frame.columns)
            if unknown:
                raise ValueError(f"{name} lacks its key columns {sorted(unknown)}")
            suite = self.suites.get(name, ()) if validate else ()
            place = None
            if path is None:
                enforce(frame, suite, name)
            else:
                place, columns = f"{path}/{name}", frame.columns
                rows = frame.drop(STAMP)
                if suite:
                    gate = Gate(suite, name)
                    write_checked_snapshot(rows, place, STAMP, run_ts, gate.verdict, watch=gate.watch)
                else:
                    write_snapshot(rows, place, STAMP, run_ts)
                stored = read_snapshot(spark, place, STAMP, run_ts).drop(STAMP)
                frame = stamp(stored, run_ts).select(*columns)
            done[name] = Dataset(name, frame, node.keys, place)
        return done


def run_reports(
    spark: SparkSession,
    sources: Callable[[str], DataFrame],
    run_ts: str,
    path: str | None = None,
    suites: Mapping[str, Sequence[Expectation]] = SUITES,
) -> dict[str, DataFrame]:
    """Both daily reports from one run, published as global views."""
    done = Pipeline(suites=suites).run(
        spark, ["daily_category_metrics", "daily_order_metrics"], sources, run_ts, path
    )
    return {
        "daily_category_report": gold.daily_category_report(done["daily_category_metrics"].df),
        "daily_order_report": gold.daily_order_report(done["daily_order_metrics"].df),
    }
