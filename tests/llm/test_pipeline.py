"""Each stage of the pipeline against a plain version of itself."""

import zlib

import numpy as np
import pytest
from samples import MESSY, crowded, frame
from test_jaccard_join import brute as classes_of
from test_line_dedup import brute as lines_of
from test_packing import check as check_packing

import corpus_pipeline
from sparrowmill.llm import quality
from sparrowmill.llm.common import stored
from sparrowmill.llm.jaccard_join import one_of_each_class
from sparrowmill.llm.line_dedup import without_shared_lines
from sparrowmill.llm.quality import keep_quality


@pytest.fixture(scope="module")
def passed(spark, tiny):
    docs, out = spark.read.parquet(f"{tiny}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = stored(stage(spark, docs, tiny))
    return [*out, docs]


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_order_and_columns(passed):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "best-fit packing"]
    assert all(df.dtypes == passed[0].dtypes for df in passed[:-1])


def test_rejected_documents_go(spark, tiny, passed):
    scores = quality.score_quality(passed[0], spark.read.parquet(f"{tiny}/labels.parquet"))
    good = {r["doc_id"] for r in scores.where("predicted = 1").collect()}
    assert rows(passed[1]) == [r for r in rows(passed[0]) if r[0] in good]
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    kept = {i for i, _ in rows(passed[1])}
    assert np.mean([(i in kept) == bool(q) for i, q in truth.items()]) > 0.9


def test_shared_lines_go(passed):
    assert rows(passed[2]) == sorted((i, t) for i, t, *_ in lines_of(rows(passed[1]), 40, 5))
    assert all(r["n_chars"] == len(r["text"]) for r in passed[2].collect())


def test_one_of_each_class_stays(passed):
    want = [i for i, c, _ in classes_of(rows(passed[2])) if i == c]
    assert [i for i, _ in rows(passed[3])] == sorted(want)


def test_what_stays_is_packed(passed):
    check_packing(passed[4].collect(), rows(passed[3]), 2048)


def test_run_applies_all_stages(spark, tiny, passed):
    got = corpus_pipeline.run(spark, tiny)
    assert got.dtypes == passed[4].dtypes
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got.select(columns).collect()) == sorted(passed[4].select(columns).collect())


def test_packed_rows_have_their_ids(passed):
    rows = passed[4].collect()
    assert rows and all(len(r["ids"]) == 4 * r["length"] for r in rows)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)


def test_stages_take_columns_of_any_name(spark):
    """Columns named like what the stages add inside: same rows, all columns, no crash."""
    docs = crowded(spark, MESSY)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    kept = [
        without_shared_lines(docs), keep_quality(docs, labels, threshold=0.0), one_of_each_class(docs),
    ]
    plain = frame(spark, MESSY)
    want = [
        without_shared_lines(plain), keep_quality(plain, labels, threshold=0.0), one_of_each_class(plain),
    ]
    for got, same in zip(kept, want):
        assert got.columns == docs.columns
        key = lambda r: repr((r["doc_id"], r["text"]))
        assert sorted(map(key, got.select("doc_id", "text").collect())) == sorted(map(key, same.select("doc_id", "text").collect()))
