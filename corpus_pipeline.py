"""Corpus pipeline: the stages that documents go through on the way to training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparrowmill.llm.common import stored, table
from sparrowmill.llm.jaccard_join import one_of_each_class
from sparrowmill.llm.line_dedup import without_shared_lines
from sparrowmill.llm.packing import pack
from sparrowmill.llm.quality import keep_quality
from sparrowmill.llm.queries import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.7 or more."""
    return keep_quality(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of 40 characters or more that five or more of them share."""
    return without_shared_lines(docs, min_chars=40, min_docs=5)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return one_of_each_class(docs, threshold=0.8)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its token ids and its place in a sequence of 2048 tokens."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), size=2048, with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("best-fit packing", best_fit_packing),
]

# A network's scores decide the first stage, which SQL cannot express; the tests compare each stage
# with a plain version of itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, stored(docs) if place else docs, sf_dir)
    return docs
