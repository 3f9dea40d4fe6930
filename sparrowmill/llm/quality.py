"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing gives every word a fixed sparse ternary index vector and adds up, over the whole
corpus, the index vectors of the words around it. The sums of two tasks simply add, in integers, so
the result does not depend on the order of tasks. Words are hashed to a fixed number of units, which
bounds the table; a second unit of each word is its shape (runs of capitals, small letters, digits
and every other character), so that a document's typography is seen even where its words are new.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.llm.common import chunks, free, merge_slabs, text_of

LEXICAL, SHAPES, DIMS = 1 << 16, 1 << 12, 32
UNITS = LEXICAL + SHAPES
NONZERO = 4  # entries of an index vector that are not zero
WINDOW = 2  # neighbours on either side
REPEAT = 0  # the shape unit of a word that repeats the one before it
SLAB_UNITS = 256
CACHE_WORDS = 150_000
MAX_LABELLED = 20_000  # labelled rows that the network is fitted on, at most
HIDDEN = 32
SEED = 20240601

_RUNS = re.compile(r"(.)\1+", re.S)
_NOT_WORD = re.compile(r"[\W_]+")


class _Kinds(dict):
    """Translates a code point to its kind."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        return self[point]


_KINDS = _Kinds()


def shape(word: str) -> str:
    """A for capitals, a for other letters, 0 for digits, other characters as they are; runs as one."""
    if word.islower() and word.isalpha():
        return "a"
    return _RUNS.sub(r"\1", word.translate(_KINDS))


class Units(dict):
    """A word's two units, packed as lexical | shape << 32."""

    def __missing__(self, word: str) -> int:
        lower = word.lower()
        core = lower if lower.isalnum() else _NOT_WORD.sub("", lower) or word
        lexical = zlib.crc32(core.encode()) % LEXICAL
        form = LEXICAL + 1 + zlib.crc32(shape(word).encode()) % (SHAPES - 1)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = lexical | form << 32
        return lexical | form << 32


@cache
def index_vectors() -> np.ndarray:
    """(UNITS, DIMS) ternary vectors, the same everywhere."""
    rng = np.random.default_rng(SEED)
    vectors = np.zeros((UNITS, DIMS), np.int8)
    at = rng.random((UNITS, DIMS)).argsort(axis=1)[:, :NONZERO]
    signs = rng.integers(0, 2, (UNITS, NONZERO), dtype=np.int8) * 2 - 1
    np.put_along_axis(vectors, at, signs, 1)
    return vectors


def read_units(texts: list[str], known: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lexical units, shape units, words before each text and all words) of some texts."""
    words = [t.split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    before = np.append(0, np.cumsum(sizes))
    packed = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, int(before[-1]))
    lexical, form = packed & 0xFFFFFFFF, packed >> 32
    again = np.append(False, lexical[1:] == lexical[:-1])[: len(lexical)]
    again[before[:-1][before[:-1] < len(again)]] = False
    form = np.where(again, LEXICAL + REPEAT, form)
    return lexical, form, before


def add_contexts(sums: np.ndarray, lexical: np.ndarray, form: np.ndarray, before: np.ndarray) -> None:
    """Add each word's neighbours' index vectors to its units' sums, (DIMS, UNITS) doubles, which
    are exact: whole numbers below 2**53."""
    n = len(lexical)
    if not n:
        return
    own = index_vectors()[lexical].astype(np.int16) + index_vectors()[form]
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    around = np.zeros((n, DIMS), np.int16)
    for gap in range(1, WINDOW + 1):
        if gap < n:
            same = (text[gap:] == text[:-gap])[:, None]
            around[gap:] += own[:-gap] * same
            around[:-gap] += own[gap:] * same
    units = np.concatenate([lexical, form])
    for d in range(DIMS):
        column = around[:, d].astype(np.float64)
        sums[d] += np.bincount(units, np.concatenate([column, column]), UNITS)


def word_vectors(documents: DataFrame) -> np.ndarray:
    """(UNITS, DIMS) float32 vectors learnt from all texts: direction of the context sums plus
    direction of the index vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = Units(), np.zeros((DIMS, UNITS))
        for batch in chunks(batches):
            add_contexts(sums, *read_units(batch.column(0).to_pylist(), known))
        slabs = np.ascontiguousarray(sums.T).astype(np.int64).reshape(-1, SLAB_UNITS * DIMS)
        used = np.flatnonzero(slabs.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([slabs[s].tobytes() for s in used], pa.binary())],
            ["slab", "part"],
        )

    def add(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a, np.int64) + np.frombuffer(b, np.int64)).tobytes()

    sums = np.zeros((UNITS // SLAB_UNITS, SLAB_UNITS * DIMS), np.int64)
    rows = documents.select(text_of().alias("text")).mapInArrow(run, "slab int, part binary")
    for slab, part in merge_slabs(rows, add).items():
        sums[slab] = np.frombuffer(part, np.int64)
    context, index = sums.reshape(UNITS, DIMS).astype(np.float64), index_vectors().astype(np.float64)
    length = np.linalg.norm(context, axis=1, keepdims=True)
    return (context / np.maximum(length, 1) + index / np.sqrt(NONZERO)).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray, known: Units) -> np.ndarray:
    """(texts, 2 * DIMS) means of the words' lexical and shape vectors; zeros without words."""
    lexical, form, before = read_units(texts, known)
    out = np.zeros((len(texts), 2 * DIMS))
    cuts = before.tolist()
    for row, (start, stop) in enumerate(zip(cuts, cuts[1:])):
        if stop > start:
            out[row, :DIMS] = vectors[lexical[start:stop]].sum(axis=0) / (stop - start)
            out[row, DIMS:] = vectors[form[start:stop]].sum(axis=0) / (stop - start)
    return out


@dataclass
class Network:
    """Standardised inputs, one tanh layer, one logit divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        # Row by row results must not depend on which rows share a batch: einsum, not BLAS.
        z = (x - self.mean) / self.scale
        hidden = np.tanh(np.einsum("ij,jk->ik", z, self.w1) + self.b1)
        return np.einsum("ij,j->i", hidden, self.w2) + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def constant_network(share: float, width: int) -> Network:
    zeros = np.zeros
    return Network(zeros(width), np.ones(width), zeros((width, HIDDEN)), zeros(HIDDEN), zeros(HIDDEN),
                   float(np.log(share / (1 - share))))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.01) -> Network:
    """Adam on the cross-entropy; a fifth of the rows is kept for the temperature."""
    share = (y.sum() + 1) / (len(y) + 2)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    kept, train = order[: len(y) // 5], order[len(y) // 5 :]
    if len(train) < 10 or len(set(y[train].tolist())) < 2:
        return constant_network(share, x.shape[1])
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
    z = (x - mean) / scale
    width = x.shape[1]
    params = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        shuffled = rng.permutation(train)
        for start in range(0, len(shuffled), batch):
            rows = shuffled[start : start + batch]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            error = 1 / (1 + np.exp(-(hidden @ params[2] + params[3][0]))) - y[rows]
            back = error[:, None] * params[2] * (1 - hidden**2)
            grads = [z[rows].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                g = g / len(rows) + 1e-4 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    if len(kept):
        logits, sign = net.logits(x[kept]), 2 * y[kept] - 1
        # Least negative log-likelihood on the kept rows; never sharper than fitted, as a fifth of a
        # small sample without an error would ask for a temperature of zero.
        grid = np.geomspace(1, 10, 60)
        loss = [np.logaddexp(0, -sign * logits / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(4)) == 2


def fitted_network(base: DataFrame, labels: DataFrame, vectors, max_labelled: int) -> Network:
    """The network fitted on a bounded sample of labelled rows; ``vectors`` is a broadcast."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).select("doc_id", "quality")
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Units()
        for batch in chunks(batches):
            x = pooled(batch.column(1).to_pylist(), vectors.value, known)
            rows = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(rows, pa.binary())], ["doc_id", "quality", "x"]
            )

    # max_labelled rows of two numbers bound the broadcast.
    labelled = base.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
    rows = labelled.mapInArrow(features, "doc_id long, quality int, x binary")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
    sample = sorted((r[0], r[1], bytes(r[2])) for r in rows.collect())
    if not sample:
        return constant_network(0.5, 2 * DIMS)
    x = np.frombuffer(b"".join(r[2] for r in sample)).reshape(len(sample), -1)
    return fit(x, np.array([r[1] for r in sample], float))


def with_scores(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Documents with all their columns, whatever their names, and last the probability of quality
    label 1, as ``__score`` or, where that is taken, with more underscores before it.

    The word vectors come from all documents. The network is fitted on at most ``max_labelled``
    labelled documents, those with the smallest hash of their id among rows of ``labels`` with
    quality 0 or 1 that are not held out (crc32 of the id as text, mod 4, is 2); ids with
    contradicting labels are left out, and of rows that repeat an id one is taken. Only the text
    enters a score. Null and empty texts are scored as documents without words. Repeated rows get
    equal scores. Without labels of both kinds every score is the smoothed share of label 1. An
    empty table gives an empty table.
    """
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # UNITS x DIMS floats: 9 MB at any size.
    vectors = documents.sparkSession.sparkContext.broadcast(word_vectors(base))
    network = fitted_network(base, labels, vectors, max_labelled)
    text, score_ = free(documents, "__text", "__score")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Units()
        for batch in chunks(batches, text):
            x = pooled(batch.column(batch.num_columns - 1).to_pylist(), vectors.value, known)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(network.probabilities(x))], [*batch.schema.names[:-1], score_]
            )

    schema = T.StructType([*documents.schema.fields, T.StructField(score_, T.DoubleType())])
    return documents.select("*", text_of().alias(text)).mapInArrow(score, schema)


def score_quality(
    documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, threshold: float = 0.7
) -> DataFrame:
    """doc_id, held_out, score (see ``with_scores``) and predicted (1 if score >= ``threshold``) of
    every document row. A missing doc_id counts as empty text for the remainder: not held out.
    Other columns are not read."""
    scored = with_scores(documents.select("doc_id", "text"), labels, max_labelled)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
        F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"),
    )


def keep_quality(
    documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, threshold: float = 0.7
) -> DataFrame:
    """The documents, with their columns, whose score is ``threshold`` or more."""
    scored = with_scores(documents, labels, max_labelled)
    score = scored.columns[-1]
    return scored.where(F.col(score) >= threshold).drop(score)
