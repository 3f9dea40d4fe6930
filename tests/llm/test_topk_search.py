import math

import numpy as np
import pytest

from sparrowmill.llm.topk_search import Best, cover_tree, dual_search, top_k


def brute(rows, asked, k):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, a in whole:
        if asked(q):
            scores = {(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)}
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, rows, asked, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score string")
    return sorted(tuple(r) for r in top_k(df, df.where(asked), k).collect())


def with_extras(rows):
    return [(i, v, 1, "x") for i, v in rows]


def test_random_ties_and_dirty_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(i, np.round(rng.normal(size=4), 1).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i + 1000, rows[i][1]) for i in range(50)]  # ties
    rows += [(2000, None), (2050, [1.0, None, 0.0, 0.0]), (2100, [float("nan")] * 4), (None, [1.0] * 4),
             (2150, [float("inf"), 0.0, 0.0, 0.0]), (2200, []), (2250, []), (2300, [0.5, 0.25])]
    assert run(spark, with_extras(rows), "vec_id % 50 = 0") == brute(rows, lambda i: i % 50 == 0, 5)


def test_fewer_rows_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.0, -1.0])]
    assert run(spark, with_extras(rows), "true") == brute(rows, lambda i: True, 5)
    assert run(spark, with_extras(rows[:1]), "true") == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty, empty).collect() == []


def test_large_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e6, 2.0]), (2, [-1e30, 0.0])]
    found = run(spark, with_extras(rows), "vec_id = 0")
    assert [r[2] for r in found] == [1, 2]
    assert found[1][3] == -(2**63)


@pytest.mark.parametrize("spread", [0.0, 0.1, 5.0])
def test_nodes_cover_their_members(spread):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 5)) * spread
    points = np.floor(256 * (centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 5)) * 0.05))

    def visit(node):
        away = np.sqrt(((points[node.members] - node.centre) ** 2).sum(axis=1))
        assert away.max() <= node.radius + 1e-6
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
            for child in node.children:
                visit(child)

    visit(cover_tree(points, 16))


def test_pairs_are_pruned():
    """Far clusters are not compared: fewer products than pairs."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 3)) * 1000
    data = np.floor(centres[np.arange(4000) % 40] + rng.normal(size=(4000, 3)))
    queries = data[:40]
    best, seen = Best(np.arange(40), 3, np.full(40, -np.inf)), []
    add = best.add
    best.add = lambda rows, ids, scores: (seen.append(scores.size), add(rows, ids, scores))
    dual_search(cover_tree(queries, 4), queries, cover_tree(data, 32), data, np.arange(4000), best)
    scores = queries @ data.T
    for q in range(40):
        scores[q, q] = -np.inf
        assert best.found[q].tolist() == sorted(range(4000), key=lambda i: (-scores[q, i], i))[:3]
    assert sum(seen) < 0.5 * 40 * 4000


@pytest.mark.parametrize("copies", [2, 7])
def test_repeated_rows_are_one_answer(spark, copies):
    rng = np.random.default_rng(11)
    rows = [(i, np.round(rng.normal(size=4), 1).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, np.round(rng.normal(size=4), 1).astype(np.float32).tolist()) for i in range(1, 40)]  # other vectors
    rows = [r for r in rows for _ in range(copies)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for parts in (1, 5):
        dealt = df.repartitionByRange(parts, "vec_id")
        found = top_k(dealt, dealt.where("vec_id % 50 = 0"), 5).collect()
        assert sorted(tuple(r) for r in found) == sorted(set(brute(rows[::copies], lambda i: i % 50 == 0, 5)))


def test_best_keeps_ids_not_rows():
    best = Best(np.array([100, 101]), 3, np.full(2, -np.inf))
    ids = np.array([7, 7, 7, 7, 7, 1, 2, 3])
    scores = np.array([[9.0, 9, 9, 9, 8, 3, 2, 1], [0.0, 0, 0, 0, 0, 0, 0, 0]])
    best.add(np.arange(2), ids, scores)
    best.add(np.arange(2), ids, scores)
    assert best.found.tolist() == [[7, 7, 1], [1, 2, 3]] and best.scores.tolist() == [[9, 8, 3], [0, 0, 0]]


@pytest.mark.parametrize("first_id", [5000, 0])
def test_queries_from_elsewhere(spark, first_id):
    """Queries that are like each other and unlike the data, under ids of their own or of other rows."""
    rng = np.random.default_rng(13)
    data = [(i, np.round(rng.normal(size=4), 1).astype(np.float32).tolist()) for i in range(200)]
    asked = [(first_id + i, (np.round(rng.normal(size=4), 1) + 50).astype(np.float32).tolist()) for i in range(20)]
    frames = [spark.createDataFrame(rows, "vec_id long, embedding array<float>") for rows in (data, asked)]
    want = []
    for q, a in asked:
        scores = sorted((-sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b)), i)
                        for i, b in data if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in top_k(*frames, 5).collect()) == sorted(want)


def test_scores_below_a_long_are_answers(spark):
    rows = [(0, [1e30, 1.0])] + [(i, [-1e6 * i, 0.0]) for i in range(1, 8)]
    assert len(run(spark, with_extras(rows), "vec_id < 8")) == 8 * 5
