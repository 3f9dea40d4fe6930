"""Alignment of two tokenizers' tokens by merge_asof over byte offsets, keyed by document."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparrowmill.llm.common import chunks, stored, text_of
from sparrowmill.llm.packing import encoder

# Both tokenizers always cut before a single space between two characters that are no white space.
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
CACHE_WORDS, CACHE_CHARS = 600_000, 16_000_000  # the cache starts again when it holds as many
BLOCK_TOKENS = 250_000  # merge_asof takes about as many tokens of a side at a time
HELD_PAIRS = 500_000  # a task hands its id pairs on when it has counted so many different ones
BATCH_ROWS = 1000  # documents that Spark hands to Python at a time
# A pair is frequent if it makes up 1 / FREQUENT of all links, so there are at most FREQUENT of them.
FREQUENT = 200_000


class Side:
    """One tokenizer's ids of words, flat, and the bytes of each id (None: it spells nothing)."""

    def __init__(self, tokens: list[bytes | None], encode):
        self.tokens, self.encode = tokens, encode
        self.width = np.array([len(t or b"") for t in tokens], np.int64)
        self.clear()

    def clear(self) -> None:
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)  # of each word's ids; word 0 has none

    def learn(self, words: list[str], whole: bytes, lengths: np.ndarray) -> np.ndarray:
        """Keep the ids of new words, given with the bytes of all, a space before each, and of each one.
        Returns whether a word's tokens spell a space and the word."""
        ids, sizes = self.encode(words, lengths)
        ends = np.cumsum(sizes)
        spelt = list(map(self.tokens.__getitem__, ids.tolist()))
        spans = np.diff(np.cumsum(np.append(0, self.width[ids]))[ends], prepend=0)
        right = np.ones(len(words), bool)
        if None in spelt or b"".join(spelt) != whole or (spans != lengths).any():
            right[:] = [
                None not in (part := spelt[i:j]) and b"".join(part) == b" " + word.encode()
                for word, i, j in zip(words, (ends - sizes).tolist(), ends.tolist())
            ]
        self.ends = np.concatenate([self.ends, ends + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        return right

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after another, number of ids of each word)."""
        ends = self.ends[words]
        sizes = ends - np.where(words > 0, self.ends[words - 1], 0)
        shift = ends - np.cumsum(sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes


def flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes


@cache
def tokenizers_of(path_a: str, path_b: str):
    """(bytes of the ids, encoder of words) for each side, read once a worker."""
    from sentencepiece import SentencePieceProcessor

    byte_bpe = encoder(path_a)
    pieces = SentencePieceProcessor(model_file=path_b)

    def bytes_of(i: int) -> bytes | None:
        try:
            return byte_bpe.decode_single_token_bytes(i)
        except KeyError:
            return None

    tokens_a = [bytes_of(i) for i in range(byte_bpe.n_vocab)]
    width = np.array([len(t or b"") for t in tokens_a], np.int64)

    def spelling(i: int) -> bytes | None:
        if pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i):
            return None
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Words without white space at their ends are encoded as one text, whose tokens their spaces part.
        if words[0] != words[0].strip():
            return flat([byte_bpe.encode_ordinary(" " + w) for w in words])
        ids = byte_bpe.encode_to_numpy(" " + " ".join(words)).astype(np.uint32)
        after = np.searchsorted(np.cumsum(width[ids]), np.cumsum(lengths)) + 1
        return ids, np.diff(after, prepend=0)

    def encode_b(words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return flat(pieces.encode(words, num_threads=1))

    tokens_b = [spelling(i) for i in range(pieces.get_piece_size())]
    return (tokens_a, encode_a), (tokens_b, encode_b)


class Tokens:
    """Both tokenizers over texts. Words are encoded once and kept while they fit the cache."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = (Side(*side) for side in tokenizers_of(path_a, path_b))
        self.clear()

    def clear(self) -> None:
        self.a.clear()
        self.b.clear()
        self.codes: dict[str, int] = {}
        self.same = np.ones(1, bool)
        self.chars = 0

    def encode(self, texts: list[str]):
        """ids, number of ids of each text, for a and then b; a text that a side does not spell
        as it is has none."""
        if len(self.codes) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.clear()
        words = [BETWEEN_WORDS.split(t) if t else [] for t in texts]
        unseen = list(set(chain.from_iterable(words)).difference(self.codes))
        # Words that begin or end with white space apart: the others are encoded in one go.
        odd = [w for w in unseen if w != w.strip()]
        bare = [w for w in unseen if w == w.strip()] if odd else unseen
        for new in filter(None, (bare, odd)):
            whole = (" " + " ".join(new)).encode()
            lengths = np.fromiter((len(w.encode()) + 1 for w in new), np.int64, len(new))
            right = self.a.learn(new, whole, lengths) & self.b.learn(new, whole, lengths)
            self.same = np.concatenate([self.same, right])
            self.codes.update(zip(new, range(len(self.codes) + 1, len(self.codes) + len(new) + 1)))
            self.chars += sum(map(len, new))
        held = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter(
            map(self.codes.__getitem__, chain.from_iterable(words)), np.int64, held.sum()
        )
        doc = np.repeat(np.arange(len(texts)), held)
        wrong = np.zeros(len(texts), bool)
        wrong[doc[~self.same[codes]]] = True
        kept = ~wrong[doc]
        codes, doc = codes[kept], doc[kept]
        sides = []
        for side in (self.a, self.b):
            ids, sizes = side.of(codes)
            sides += [ids, np.bincount(doc, sizes, len(texts)).astype(np.int64)]
        return sides


def group_ends(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens of a and of b before each offset at which tokens of both end."""
    at = np.searchsorted(end_b, end_a)
    both = np.flatnonzero(end_b[np.minimum(at, len(end_b) - 1)] == end_a) if len(end_b) else at[:0]
    return both + 1, at[both] + 1


def overlaps(
    doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all pairs of tokens whose byte ranges overlap.

    Of two ranges that overlap, one covers the other's start: the backward merge finds the token that
    covers each start, in both directions, and pairs with one start are counted in the first only.
    """
    a = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(doc_a))})
    b = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(doc_b))})
    covered_a = pd.merge_asof(a, b, on="start", by="doc")
    covered_b = pd.merge_asof(b, a, on="start", by="doc")
    in_a, in_b = covered_b["a"].to_numpy(np.int64), covered_b["b"].to_numpy()
    inside = start_a[in_a] < start_b[in_b]
    return (
        np.concatenate([covered_a["a"].to_numpy(), in_a[inside]]),
        np.concatenate([covered_a["b"].to_numpy(np.int64), in_b[inside]]),
    )


class Batch:
    """Tokens of some documents: ids, document and byte offsets on both sides, groups and links."""

    def __init__(self, ids_a, sizes_a, ids_b, sizes_b, width_a, width_b):
        self.sizes_a, self.sizes_b, self.docs = sizes_a, sizes_b, len(sizes_a)
        self.ids_a, self.ids_b = ids_a, ids_b
        self.doc_a = np.repeat(np.arange(self.docs), sizes_a)
        self.doc_b = np.repeat(np.arange(self.docs), sizes_b)
        self.end_a, self.end_b = np.cumsum(width_a[ids_a]), np.cumsum(width_b[ids_b])
        self.start_a, self.start_b = self.end_a - width_a[ids_a], self.end_b - width_b[ids_b]
        self.group_a, self.group_b = group_ends(self.end_a, self.end_b)

    def blocks(self) -> Iterator[tuple[slice, slice]]:
        """Runs of whole groups, so that a very long text is not merged in one go."""
        last_a = last_b = 0
        while last_a < len(self.ids_a):
            at = min(np.searchsorted(self.group_a, last_a + BLOCK_TOKENS), len(self.group_a) - 1)
            next_a, next_b = int(self.group_a[at]), int(self.group_b[at])
            yield slice(last_a, next_a), slice(last_b, next_b)
            last_a, last_b = next_a, next_b

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document, id of a << 32 | id of b) of all links, block by block."""
        for a, b in self.blocks():
            in_a, in_b = overlaps(self.doc_a[a], self.start_a[a], self.doc_b[b], self.start_b[b])
            pair = self.ids_a[a][in_a].astype(np.int64) << 32 | self.ids_b[b][in_b].astype(np.int64)
            yield self.doc_a[a][in_a], pair

    def group_texts(self, names: list[bytes], first_b: int) -> list[bytes]:
        """Each document's groups: ids of a, a bar, ids of b; groups parted by semicolons.

        ``names`` has every id with a comma and then every id with the mark that closes its side.
        """
        last_a, last_b = np.zeros(len(self.ids_a), bool), np.zeros(len(self.ids_b), bool)
        last_a[self.group_a - 1], last_b[self.group_b - 1] = True, True
        group_of_a, group_of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before = np.concatenate([[0], self.group_b])
        place_a = np.arange(len(self.ids_a)) + before[group_of_a]
        place_b = np.arange(len(self.ids_b)) + self.group_a[group_of_b]
        code = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        code[place_a] = self.ids_a + last_a * (len(names) // 2)
        code[place_b] = first_b + self.ids_b + last_b * (len(names) // 2)
        pieces = list(map(names.__getitem__, code.tolist()))
        cuts = [0, *np.cumsum(self.sizes_a + self.sizes_b).tolist()]
        return [b"".join(pieces[i:j])[:-1] for i, j in zip(cuts, cuts[1:])]


def _counted(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, found = pd.factorize(pairs)
    return found, np.bincount(codes, counts, len(found)).astype(np.int64)


def _packed(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    data = ids.astype("<u4")
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return pa.array([data[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started meanwhile hand BATCH_ROWS rows at a time to Python, in place of ten times as many."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "groups string, a_ids binary, b_ids binary, pair long, count long"
)


def _batch_of(n: int, **columns) -> pa.RecordBatch:
    """A record batch of ALIGNED with nulls in the columns that are not given."""
    names = [c.split()[0] for c in ALIGNED.split(", ")]
    types = {"binary": pa.binary(), "string": pa.string(), "long": pa.int64()}
    kinds = [types[c.split()[1]] for c in ALIGNED.split(", ")]
    filled = [columns[c] if c in columns else pa.nulls(n, t) for c, t in zip(names, kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(filled, kinds)], names)


def _aligner(path_a: str, path_b: str, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path_a, path_b)
        n_a, n_b = len(tokens.a.tokens), len(tokens.b.tokens)
        digits = [b"%d" % i for i in (*range(n_a), *range(n_b))]
        names = [d + b"," for d in digits] + [d + (b"|" if i < n_a else b";") for i, d in enumerate(digits)]
        row = TaskContext.get().partitionId() << 40
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in chunks(batches):
            n = batch.num_rows
            ids_a, sizes_a, ids_b, sizes_b = tokens.encode(batch.column("text").to_pylist())
            b = Batch(ids_a, sizes_a, ids_b, sizes_b, tokens.a.width, tokens.b.width)
            n_links = np.zeros(n, np.int64)
            for doc, pair in b.links():
                n_links += np.bincount(doc, minlength=n)
                held.append(_counted(pair, np.ones(len(pair))))
            listed = b.group_texts(names, n_a)
            yield _batch_of(
                n, row=np.arange(row, row + n), doc_id=batch.column("doc_id"), n_a=sizes_a, n_b=sizes_b,
                n_groups=np.bincount(b.doc_a[b.group_a - 1], minlength=n), n_links=n_links,
                groups_sha256=[hashlib.sha256(g).hexdigest() if g else "" for g in listed],
                groups=[g.decode() for g in listed] if with_groups else pa.nulls(n, pa.string()),
                a_ids=_packed(ids_a, sizes_a), b_ids=_packed(ids_b, sizes_b),
            )
            row += n
            if sum(len(p) for p, _ in held) > HELD_PAIRS:
                held = [_counted(*map(np.concatenate, zip(*held)))]
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield _batch_of(len(held[0][0]), pair=held[0][0], count=held[0][1])
                    held = []
        if held:
            pairs, counts = _counted(*map(np.concatenate, zip(*held)))
            yield _batch_of(len(pairs), pair=pairs, count=counts)

    return run


def _scorer(path_a: str, path_b: str, frequent):
    """Sums over the frequent pairs of each document, and its other pairs as rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path_a, path_b)
        known, counts, best = frequent.value
        known = np.append(known, np.iinfo(np.int64).max)
        counts, best = np.append(counts, 0), np.append(best, 0)
        for batch in sized(batches):
            n = batch.num_rows
            sides = []
            for name in ("a_ids", "b_ids"):
                packed = batch.column(name).to_pylist()
                sides += [np.frombuffer(b"".join(packed), "<u4"), np.array([len(p) // 4 for p in packed], np.int64)]
            b = Batch(*sides, tokens.a.width, tokens.b.width)
            row = batch.column("row").to_numpy()
            n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for doc, pair in b.links():
                codes, found = pd.factorize(pair)
                at = np.searchsorted(known, found)
                hit = known[at] == found
                for total, value in ((n_best, best), (count_sum, counts)):
                    np.add.at(total, doc, np.where(hit, value[at], 0)[codes])
                rest = ~hit[codes]
                if rest.any():
                    yield _score_rows(row[doc[rest]], pair=pair[rest])
            yield _score_rows(row, n_best=n_best, count_sum=count_sum)

    return run


def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds about BLOCK_TOKENS tokens, or one document."""
    for batch in batches:
        sizes = [len(p) // 4 for p in batch.column("a_ids").to_pylist()]
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > BLOCK_TOKENS:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


SCORED = "row long, n_best long, count_sum long, pair long"


def _score_rows(row: np.ndarray, **columns) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCORED.split(", ")]
    columns["row"] = row
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], pa.int64()) if c in columns else pa.nulls(len(row), pa.int64()) for c in names],
        names,
    )


def aligned_tokens(documents: DataFrame, path_a: str, path_b: str, with_groups: bool = True) -> DataFrame:
    """Tokens of every whole text under both vocabularies, with the groups they form; stored.

    ``a`` encodes a space and the text by the byte-level file at ``path_a``, ``b`` the text by the
    piece model at ``path_b``, which puts the space itself; special tokens' strings are plain text.
    A row per document has row (its number in the stored table), doc_id, n_a, n_b, n_groups (runs
    between offsets at which tokens of both end), n_links (pairs of tokens whose bytes overlap),
    groups_sha256, groups (``a1,a2|b1;a3|b2,b3``; null without ``with_groups``), a_ids and b_ids
    (packed little-endian unsigned 32-bit integers); its pair and count are null. Null and empty
    texts, and those that a side does not spell byte by byte, have no tokens and an empty digest.
    Other rows are ``pair`` (id of a << 32 | id of b) and ``count``, the links that join the two in
    one task's documents. Repeated rows stay; no other column is read; an empty table gives none.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    with small_batches(documents.sparkSession):
        return stored(texts.mapInArrow(_aligner(path_a, path_b, with_groups), ALIGNED), compression="zstd")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (links that join the two ids in all documents), best (no id of a is joined to the
    pair's id of b more often). A window holds at most the ids of a."""
    counted = aligned.where("pair is not null").groupBy("pair").agg(F.sum("count").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    return counted.withColumn("best", F.col("count") == F.max("count").over(of_b))


def align(documents: DataFrame, path_a: str, path_b: str, with_groups: bool = True) -> DataFrame:
    """``aligned_tokens`` with two sums over each document's links.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent of its
    id of b in all documents, ties included), count_sum (of the pairs' counts), groups_sha256, groups,
    a_ids and b_ids, a row per row of ``documents``.

    The pairs that make up 1 / FREQUENT of all links are broadcast, at most FREQUENT of them whatever
    the input. Links of the other pairs are joined to the counts by shuffle; no such pair can have
    more than that share of the rows, so none is hot. Ties, nulls and repeated rows as in
    ``aligned_tokens``.
    """
    spark = documents.sparkSession
    aligned = aligned_tokens(documents, path_a, path_b, with_groups)
    counted = stored(pair_counts(aligned))
    links = int(counted.agg(F.sum("count")).head()[0] or 0)
    top = counted.where(F.col("count") * FREQUENT >= links).orderBy("pair").toPandas()
    frequent = spark.sparkContext.broadcast(
        (top["pair"].to_numpy(np.int64), top["count"].to_numpy(np.int64), top["best"].to_numpy(np.int64))
    )
    documents_of = aligned.where("row is not null").drop("pair", "count")
    ids = documents_of.select("row", "a_ids", "b_ids")
    with small_batches(spark):
        scored = stored(ids.mapInArrow(_scorer(path_a, path_b, frequent), SCORED))
    rare = (
        scored.where("pair is not null").groupBy("row", "pair").agg(F.count("*").alias("n"))
        .join(counted, "pair")
        .select("row", F.when(F.col("best"), F.col("n")).otherwise(0).alias("n_best"),
                (F.col("n") * F.col("count")).alias("count_sum"))
    )
    sums = (
        scored.where("pair is null").select("row", "n_best", "count_sum").unionByName(rare)
        .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return documents_of.join(sums, "row").drop("row")
