import random
import re
from collections import Counter

import numpy as np
import pytest
from samples import MESSY, frame

from sparrowmill.llm import jaccard_join
from sparrowmill.llm.components import components
from sparrowmill.llm.jaccard_join import (
    common_counts, link_bucket, near_classes, one_of_each_class, prefix_length, shingle_hashes, signatures,
)


def shingles(text):
    found = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), Counter()
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if common / (len(sets[i]) + len(sets[j]) - common) >= 0.8:
                links[i] += 1
                links[j] += 1
                old, new = root[j], root[i]
                root = [new if r == old else r for r in root]
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[i]] = min(least.get(root[i], doc_id), doc_id)
    return sorted(((d, None if d is None else least[root[i]], links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def run(df):
    return sorted((tuple(r) for r in near_classes(df).collect()), key=repr)


def family(rng, members, size=120, edits=3):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(members):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("rows_per_tile", [1024, 16])
def test_families_against_brute_force(spark, monkeypatch, rows_per_tile):
    monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", rows_per_tile)
    monkeypatch.setattr(jaccard_join, "FAMILY_ROWS", rows_per_tile)
    rng = random.Random(9)
    texts = [t for n in (1, 2, 2, 5, 60) for t in family(rng, n, edits=6)]
    texts += [texts[-1]] * 25 + ["a b c", "a b c", "A, b. C!", "a b c d", "same words here now ok"]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} {' '.join(f'o{rng.randrange(10**6)}' for _ in range(60))}" for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert run(frame(spark, rows)) == brute(rows)


def test_edge_cases(spark, messy, nothing):
    assert run(messy) == brute(MESSY)
    assert run(nothing) == []
    assert run(frame(spark, [(1, None), (2, "")])) == [(1, 1, 0), (2, 2, 0)]
    kept = one_of_each_class(messy)
    assert kept.columns == messy.columns
    ids = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert ids == sorted([m for m in set(MESSY) if m[0] != 6 and m[0] is not None]
                         + [m for m in MESSY if m[0] is None], key=repr)


def test_recall_is_what_the_prefix_promises():
    rng = np.random.default_rng(3)
    trees, depth = jaccard_join.TREES, jaccard_join.DEPTH
    shortest = prefix_length(0.8, trees, depth, 0.9999)
    assert shortest == 5 and prefix_length(0.8, trees, depth, 0.99999) < shortest
    met, agreed = 0, []
    for _ in range(300):
        common = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
        a, b = (np.append(common, rng.integers(0, 1 << 63, 20, dtype=np.uint64)) for _ in range(2))
        x, y = signatures([a, b], trees * depth)
        agreed.append((x == y).mean())
        same = (x == y).reshape(trees, depth)[:, :shortest].all(axis=1)
        met += same.any()
    assert met >= 299 and abs(np.mean(agreed) - 0.8) < 0.01


def test_a_bucket_gives_one_link_a_member():
    label = np.array([[1, 2, 3], [1, 2, 3], [1, 2, 4], [1, 2, 9]], np.uint16)
    signature = np.array([[1] * 8, [1] * 8, [1] * 7 + [2], [5] * 8], np.uint16)
    links = link_bucket(signature, label, 2, 0.8)
    assert len(links) == 2 and {i for pair in links for i in pair} == {0, 1, 2}


def test_common_counts_against_sets():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000), dtype=np.uint64)) for _ in range(12)]
    common = common_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert common[i, j] == len(np.intersect1d(a, b))


def test_shingle_hashes_follow_the_words():
    known = jaccard_join.WordHashes()
    a = shingle_hashes("a b c d e f".split(), known)
    assert len(a) == 2 and a[1] == shingle_hashes("b c d e f".split(), known)[0]
    assert len(shingle_hashes([], known)) == 0
    assert shingle_hashes(["a"], known)[0] != shingle_hashes(["a", "a"], known)[0]


def test_components_against_brute_force(spark):
    rng = random.Random(8)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    root = {n: n for pair in links if pair[0] != pair[1] for n in pair}
    for a, b in links * 80:
        if a != b:
            root[a] = root[b] = min(root[a], root[b])
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == root
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
