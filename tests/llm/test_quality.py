import math
import zlib

import numpy as np
import pytest
from samples import MESSY, frame

from sparrowmill.llm import quality


@pytest.fixture(scope="module")
def labels(spark, small):
    return spark.read.parquet(f"{small}/labels.parquet")


def test_held_out_accuracy(documents, labels, texts):
    rows = {r[0]: r for r in quality.score_quality(documents, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert set(rows) == set(texts)
    for r in rows.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows.values() if r["held_out"] and r["doc_id"] in truth]
    right = np.mean([r["predicted"] == truth[r["doc_id"]] for r in held])
    assert len(held) > 50 and right >= 0.95


def test_held_out_labels_do_not_matter(spark, documents, labels):
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    some = documents.where("doc_id < 300")
    assert sorted(quality.score_quality(some, labels).collect()) == sorted(quality.score_quality(some, flipped).collect())


def test_edge_cases(spark, messy, nothing, labels):
    dirty = spark.createDataFrame(
        [(4, 1, 0), (4, 0, 0), (5, None, 0), (None, 1, 0), (6, 7, 0), (10, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.score_quality(messy, dirty).collect()
    assert len(rows) == len(MESSY) and all(r["score"] == rows[0]["score"] for r in rows)
    rows = quality.score_quality(messy, labels.limit(0)).collect()
    assert {r["score"] for r in rows} == {0.5}
    assert quality.score_quality(nothing, labels).collect() == []
    kept = quality.keep_quality(messy, labels.limit(0), threshold=0.0)
    assert kept.columns == messy.columns and kept.count() == len(MESSY)


def test_equal_texts_get_equal_scores(spark, labels, documents):
    rows = [(i, t) for i, t in documents.select("doc_id", "text").limit(60).collect()]
    twice = frame(spark, rows + [(i + 10_000, t) for i, t in rows] + [(90_005, None), (90_006, "")])
    found = {r["doc_id"]: r["score"] for r in quality.score_quality(twice, labels).collect()}
    assert all(found[i] == found[i + 10_000] for i, _ in rows)


def test_context_sums_against_a_plain_loop():
    texts = ["a b c a", "", "Solo", "x x y. Z!"]
    lexical, form, before = quality.read_units(texts, quality.Units())
    sums = np.zeros((quality.DIMS, quality.UNITS))
    quality.add_contexts(sums, lexical, form, before)
    index, want = quality.index_vectors().astype(int), {}
    for t in range(len(texts)):
        for i in range(before[t], before[t + 1]):
            for j in range(max(before[t], i - 2), min(before[t + 1], i + 3)):
                if j != i:
                    for unit in (lexical[i], form[i]):
                        want[unit] = want.get(unit, 0) + index[lexical[j]] + index[form[j]]
    for unit in range(quality.UNITS):
        if unit in want or sums[:, unit].any():
            assert (sums[:, unit] == want[unit]).all()
    assert form[before[3] + 1] == quality.LEXICAL + quality.REPEAT


def test_index_vectors_are_sparse_and_ternary():
    vectors = quality.index_vectors()
    assert set(np.unique(vectors)) == {-1, 0, 1} and ((vectors != 0).sum(axis=1) == quality.NONZERO).all()


def test_temperature_does_not_change_the_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6))
    y = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(float)
    net = quality.fit(x, y)
    assert net.temperature >= 1
    assert ((net.probabilities(x) >= 0.5) == (y == 1)).mean() > 0.8
    assert (np.argsort(net.logits(x)) == np.argsort(net.probabilities(x), kind="stable")).mean() > 0.99


def test_shapes_of_very_long_words_are_whole():
    head = "A1" * 200
    assert quality.shape(head + "-x") == "A0" * 200 + "-a"
    known = quality.Units()
    assert known[head + "-"] >> 32 != known[head + "+"] >> 32
    assert quality.shape("中" * 1_000_000 + "。") == "a。"


def plain_features(texts):
    """Pooled vectors of some texts, which are also the corpus, word by word."""
    index, contexts, units = quality.index_vectors().astype(float), {}, []
    for text in texts:
        lexical, form, _ = quality.read_units([text or ""], quality.Units())
        words = list(zip(lexical.tolist(), form.tolist()))
        for i, own in enumerate(words):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if j != i:
                    for unit in own:
                        contexts[unit] = contexts.get(unit, 0) + index[words[j][0]] + index[words[j][1]]
        units.append(words)

    def vector(unit):
        context = contexts.get(unit, np.zeros(quality.DIMS))
        return context / max(math.sqrt(sum(c * c for c in context)), 1) + index[unit] / 2

    nothing = np.zeros(2 * quality.DIMS)
    return [
        np.concatenate([sum(vector(w[side]) for w in words) / len(words) for side in (0, 1)]) if words else nothing
        for words in units
    ]


def test_scores_equal_a_plain_version(spark):
    """Context sums, pooling and the network's forward pass, unit by unit."""
    rng = np.random.default_rng(8)
    good, bad = ["the", "quiet", "river", "runs", "slowly", "home"], ["BUY", "now!!!", "$$$", "click", "FREE", "win"]
    rows = [(i, " ".join(rng.choice(bad if i % 3 else good, rng.integers(3, 12)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "one")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    features = dict(zip((i for i, _ in rows), plain_features([t for _, t in rows])))
    known = [i for i in range(150) if zlib.crc32(str(i).encode()) % 4 != 2]
    x = np.array([features[i] for i in known]).astype(np.float32).astype(float)
    net = quality.fit(x, np.array([float(i % 3 == 0) for i in known]))
    for r in quality.score_quality(frame(spark, rows), labels).collect():
        z = (features[r["doc_id"]] - net.mean) / net.scale
        hidden = [math.tanh(sum(z * net.w1[:, k]) + net.b1[k]) for k in range(quality.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, net.w2)) + net.b2
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-logit / net.temperature)), abs=2e-3)
