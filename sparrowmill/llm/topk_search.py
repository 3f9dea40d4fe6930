"""Exact top-k inner products: dual-tree search over cover trees of queries and data.

Queries and data are both indexed by cover trees, and pairs of nodes are visited together. For a
query node with centre q and covering radius r and a data node with centre p and radius s, no inner
product of their members exceeds

    q.p + r|p| + s|q| + r s,

so the pair is pruned when that is below the worst kth score among the query node's queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.llm.common import stored

DATA_LEAF, QUERY_LEAF = 64, 8  # a node of so few points keeps them as a list
FANOUT = 64  # children of a node, before the points left over become one more
SPARSE = 4  # children that cover fewer points than this on average do not divide a node
CHUNK_ROWS = 8192  # data points indexed together in a task
QUERY_BLOCK = 16_384  # queries broadcast together
EXACT = float(1 << 52)


@dataclass
class Node:
    centre: np.ndarray
    radius: float  # no member is farther from the centre
    members: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(
    points: np.ndarray, leaf: int, members: np.ndarray | None = None, centre: int | None = None
) -> Node:
    """A node's children halve its covering radius: each child's centre is a member that no earlier
    child covers, so centres are separated and every member is in the first child that covers it.
    The node's own centre is its first child's.

    Points without structure, as in many dimensions, are about equally far from each other, and
    nearly every child would be a single point. Such a node stays a leaf, whose points are compared
    by one matrix product.
    """
    if members is None:
        members = np.arange(len(points))
    if centre is None:
        centre = int(members[0])
    away = _distances(points, members, centre)
    node = Node(points[centre], float(away.max()) * (1 + 1e-9), members)
    if len(members) <= leaf or node.radius == 0:
        return node
    half, left, chosen, parts = node.radius / 2, members, centre, []
    while len(left):
        near = (_distances(points, left, chosen) <= half) | (left == chosen)
        parts.append((left[near], chosen))
        left = left[~near]
        if not len(left):
            break
        chosen = int(left[0])
        if len(parts) == FANOUT:
            parts.append((left, chosen))
            break
    covered = len(members) - (len(parts[-1][0]) if len(parts) > FANOUT else 0)
    if 1 < len(parts) and covered >= SPARSE * min(len(parts), FANOUT):
        node.children = [cover_tree(points, leaf, some, at) for some, at in parts]
    return node


def _distances(points: np.ndarray, members: np.ndarray, centre: int) -> np.ndarray:
    return np.sqrt(((points[members] - points[centre]) ** 2).sum(axis=1))


class Best:
    """The k best (score, id) of each query so far, each pair once, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k = ids, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = floor  # a kth score known from elsewhere

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[rows, -1], self.floor[rows])

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores[i, j]`` of query ``rows[i]`` and data ``ids[j]``; a query is not its own answer."""
        scores = np.where(self.ids[rows][:, None] == ids[None, :], -np.inf, scores)
        least = self.worst(rows)
        # A bound from this block counts an id once, by its best row.
        names, place = np.unique(ids, return_inverse=True)
        if len(names) > self.k:
            tops = scores
            if len(names) < len(ids):
                order = np.argsort(place, kind="stable")
                starts = np.searchsorted(place[order], np.arange(len(names)))
                tops = np.maximum.reduceat(scores[:, order], starts, axis=1)
            least = np.maximum(least, -np.partition(-tops, self.k - 1, axis=1)[:, self.k - 1])
        row, column = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
        if not len(row):
            return
        touched = np.unique(row)
        place = np.append(row, np.repeat(touched, self.k))
        found = np.append(ids[column], self.found[rows[touched]].ravel())
        score = np.append(scores[row, column], self.scores[rows[touched]].ravel())
        order = np.lexsort((found, -score, place))
        place, found, score = place[order], found[order], score[order]
        again = (place[1:] == place[:-1]) & (found[1:] == found[:-1]) & (score[1:] == score[:-1])
        once = np.append(True, ~again | (score[1:] == -np.inf))
        place, found, score = place[once], found[once], score[once]
        first = np.searchsorted(place, touched)[:, None] + np.arange(self.k)
        self.scores[rows[touched]], self.found[rows[touched]] = score[first], found[first]


def distinct_rows(ids: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows without those that repeat an id and its vector."""
    if len(np.unique(ids)) == len(ids):
        return ids, points
    order = np.lexsort((*points.T, ids))
    ids, points = ids[order], points[order]
    new = np.append(True, (ids[1:] != ids[:-1]) | (points[1:] != points[:-1]).any(axis=1))
    return ids[new], points[new]


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors: exact while no partial sum can leave 2**52, else by Python
    integers, as the nearest double."""
    most = np.abs(queries).max(initial=0) * np.abs(data).max(initial=0) * queries.shape[1]
    if most < EXACT:
        return queries @ data.T
    whole = lambda a: np.vectorize(int, otypes=[object])(a)
    return (whole(queries) @ whole(data).T).astype(float)


def dual_search(
    query_tree: Node, queries: np.ndarray, data_tree: Node, data: np.ndarray, ids: np.ndarray, best: Best
) -> None:
    """Visit node pairs, most promising first, and compare the members of pairs of leaves."""
    def bound(q: Node, p: Node) -> float:
        ql, pl = float(np.sqrt(q.centre @ q.centre)), float(np.sqrt(p.centre @ p.centre))
        top = float(q.centre @ p.centre) + q.radius * pl + p.radius * ql + q.radius * p.radius
        return top + 1e-9 * (abs(top) + 1) + 1e-9 * ql * pl

    tie = 0
    heap = [(-bound(query_tree, data_tree), tie, query_tree, data_tree)]
    while heap:
        above, _, q, p = heapq.heappop(heap)
        if -above < best.worst(q.members).min():
            continue
        if not q.children and not p.children:
            rows = q.members[best.worst(q.members) <= -above]
            for start in range(0, len(p.members), 4096):
                some = p.members[start : start + 4096]
                best.add(rows, ids[some], products(queries[rows], data[some]))
            continue
        split_query = q.children and (not p.children or q.radius > p.radius)
        for child in q.children if split_query else p.children:
            a, b = (child, p) if split_query else (q, child)
            top = bound(a, b)
            if top >= best.worst(a.members).min():
                tie += 1
                heapq.heappush(heap, (-top, tie, a, b))


def integer_vectors(rows: DataFrame, id_column: str, vector: str, scale: float) -> DataFrame:
    """(id, vector of floor(scale * x)) of usable rows."""
    x = F.col(vector)
    usable = (
        F.col(id_column).isNotNull() & x.isNotNull()
        & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    )

    def whole(c):
        scaled = c.cast("double") * scale
        small = F.abs(scaled) < 2.0**53  # beyond, a double is an integer already, and floor() fails
        return F.when(small, F.floor(F.when(small, scaled).otherwise(0.0)).cast("double")).otherwise(scaled)

    return rows.where(usable).select(
        F.col(id_column).cast("long").alias("id"), F.transform(x, whole).alias("vector")
    )


def _partial(data: DataFrame, queries, k: int) -> DataFrame:
    """Per task and query, up to k rows that could be among its best: query_id, id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = queries.value  # width -> (ids, vectors, floors)
        state = {
            w: (cover_tree(v, QUERY_LEAF), v, Best(i, k, floor)) for w, (i, v, floor) in blocks.items() if len(i)
        }

        def search(ids: list, vectors: list) -> None:
            flat = np.concatenate([v.flatten().to_numpy() for v in vectors])
            widths = np.concatenate([pc.list_value_length(v).to_numpy() for v in vectors]).astype(np.int64)
            starts, names = np.cumsum(widths) - widths, np.concatenate(ids)
            for width in set(widths.tolist()) & set(state):
                at = np.flatnonzero(widths == width)
                points = flat[starts[at][:, None] + np.arange(width)]
                own, points = distinct_rows(names[at], points)
                tree, rows, best = state[width]
                dual_search(tree, rows, cover_tree(points, DATA_LEAF), points, own, best)

        held_ids, held, count = [], [], 0
        for batch in batches:
            if batch.num_rows:
                held_ids.append(batch.column(0).to_numpy())
                held.append(batch.column(1))
                count += batch.num_rows
            if count >= CHUNK_ROWS:
                search(held_ids, held)
                held_ids, held, count = [], [], 0
        if held:
            search(held_ids, held)
        for _, _, best in state.values():
            row, place = np.nonzero(np.isfinite(best.scores) & (best.scores >= best.floor[:, None]))
            score = np.clip(best.scores[row, place], -(2.0**63), 2.0**63 - 1024)
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.ids[row], pa.int64()), pa.array(best.found[row, place], pa.int64()),
                 pa.array(score.astype(np.int64), pa.int64())],
                ["query_id", "id", "score"],
            )

    return data.select("id", "vector").mapInArrow(run, "query_id long, id long, score long")


def _broadcast(spark, rows: list, floors: dict):
    blocks: dict[int, tuple[list, list]] = {}
    for row in rows:
        ids, vectors = blocks.setdefault(len(row[1]), ([], []))
        ids.append(row[0])
        vectors.append(row[1])
    return spark.sparkContext.broadcast({
        w: (np.array(i, np.int64), np.array(v, float).reshape(len(i), w),
            np.array([floors.get(x, -np.inf) for x in i], float))
        for w, (i, v) in blocks.items()
    })


def best_of(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return partial.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """Each query's k largest integer inner products with all other rows, ties to the smaller id.

    Components become floor(scale * x). Returns query_id, rank (from 1), the id column and score; a
    query with fewer than k other rows gets them all. Rows without id, without vector, or with a null
    or non-finite component take no part. Vectors meet only vectors of their own length (empty ones
    score 0). Rows with a query's id are its own and no answer; rows that repeat an id with one
    score are one answer. Scores beyond a long's range stop at its ends. Other columns are not read;
    an empty table gives an empty table.

    Queries are broadcast in blocks of QUERY_BLOCK, each with its cover tree; every task indexes its
    own rows, CHUNK_ROWS at a time, and keeps k rows a query. A first round among the rows of
    ``embeddings`` that have a query's id gives each query a kth score to prune by from the start, and
    bounds what tasks return; queries may come from elsewhere, whose ids no row has.
    Of query rows that repeat an id the least vector is asked.
    """
    spark = embeddings.sparkSession
    data = stored(integer_vectors(embeddings, id_column, vector, scale))
    asked = integer_vectors(queries, id_column, vector, scale)
    asked = stored(asked.groupBy("id").agg(F.min("vector").alias("vector")))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    found = None
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block) if blocks > 1 else asked
        rows = [(r[0], r[1]) for r in some.select("id", "vector").collect()]
        # Floors are scores of rows that can be answers. The ids of a block bound the broadcast.
        near = data.join(F.broadcast(some.select("id")), "id", "left_semi")
        first = best_of(_partial(near, _broadcast(spark, rows, {}), k), k).where(F.col("rank") == k)
        # At a long's lower end the score may be below it.
        floors = {r[0]: float(r[1]) for r in first.select("query_id", "score").collect() if r[1] > -(2**63)}
        part = _partial(data, _broadcast(spark, rows, floors), k)
        found = part if found is None else found.unionByName(part)
    return best_of(found, k).select("query_id", "rank", F.col("id").alias(id_column), "score")
