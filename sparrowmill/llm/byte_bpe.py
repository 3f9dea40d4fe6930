"""Byte-level BPE encoding and decoding over vectorised pre-tokens and a cache of merged words."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.common import chunks, text_of
from sparrowmill.llm.pretokens import byte_slices

CACHE_WORDS = 300_000  # about 60 MB; the cache starts again when it is full
SHORT = 48  # up to so many bytes words merge side by side; longer ones have a heap each


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of base64 tokens and ranks; rank is id."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Pairs:
    """Ranks of adjacent tokens: every way to cut a token into two tokens, in sorted order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = np.uint32(len(ranks) + max(ranks.values(), default=0) + 1)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.uint64))
        self.keys = np.append(np.array(keys, np.uint64)[order], np.uint64(2**64 - 1))
        self.values = np.append(np.array(values, np.uint32)[order], self.none)
        self.byte = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.uint32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.uint64) << np.uint64(32) | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.values[at], self.none)


def merge_words(words: list[bytes], pairs: Pairs) -> list[bytes]:
    """The packed ids of words of about one length: a row each, all rows merging side by side.

    Each round merges every word's pair of lowest rank, leftmost first, until no pair is a token.
    """
    n, width = len(words), max(map(len, words))
    length = np.fromiter(map(len, words), np.int64, n)
    raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    ids = pairs.byte[raw.reshape(n, width)]
    ranks = np.full((n, width), pairs.none, np.uint32)
    row, at = np.nonzero(np.arange(width - 1) < (length - 1)[:, None])
    ranks[row, at] = pairs.rank(ids[row, at], ids[row, at + 1])
    places = np.arange(width - 1)
    live = np.arange(n)
    live_ids, live_ranks, live_length = ids, ranks, length.copy()
    done: list[bytes] = [b""] * n
    while len(live):
        best = live_ranks.argmin(axis=1)
        every = np.arange(len(live))
        merged = live_ranks[every, best]
        going = merged != pairs.none
        if not going.all():
            for i in np.flatnonzero(~going).tolist():
                done[live[i]] = live_ids[i, : live_length[i]].astype("<u4").tobytes()
            live, best, merged = live[going], best[going], merged[going]
            live_ids, live_ranks = live_ids[going], live_ranks[going]
            live_length = live_length[going]
            every = np.arange(len(live))
            if not len(live):
                break
        source = places + (places > best[:, None])
        # The last column only moves left; what it leaves is behind the word's end.
        live_ids[:, :-1] = np.take_along_axis(live_ids, source, 1)
        live_ranks[:, :-1] = np.take_along_axis(live_ranks, source, 1)
        live_ids[every, best] = merged
        live_length -= 1
        live_ranks[every, live_length - 1] = pairs.none
        has = np.flatnonzero(best + 1 < live_length)
        live_ranks[has, best[has]] = pairs.rank(live_ids[has, best[has]], live_ids[has, best[has] + 1])
        has = np.flatnonzero(best > 0)
        live_ranks[has, best[has] - 1] = pairs.rank(live_ids[has, best[has] - 1], live_ids[has, best[has]])
    return done


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n: a heap of (rank, place) over a linked list of parts."""
    n = len(word)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is swallowed
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of its parts has been merged since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (left := before[i]) >= 0 and (r := ranks.get(word[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Words(dict):
    """Pre-token bytes to their ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.pairs = Pairs(ranks)

    def learn(self, found: set[bytes]) -> None:
        """Merge the words that are not cached yet, short ones by length class."""
        if len(self) >= CACHE_WORDS:
            self.clear()
        classes: dict[int, list[bytes]] = {}
        for word in found:
            if word not in self:
                whole = self.ranks.get(word)
                if whole is not None:
                    self[word] = whole.to_bytes(4, "little")
                elif len(word) > SHORT:
                    self[word] = np.array(merge_long(word, self.ranks), "<u4").tobytes()
                else:
                    classes.setdefault((len(word) + 3) // 4, []).append(word)
        for words in classes.values():
            for start in range(0, len(words), 4096):
                some = words[start : start + 4096]
                self.update(zip(some, merge_words(some, self.pairs)))


def encode_texts(texts: list[str], words: Words) -> list[bytes]:
    """The packed ids of each text."""
    data, starts, before = byte_slices(texts)
    cuts = starts.tolist()
    cuts.append(len(data))
    pieces = [data[a:b] for a, b in zip(cuts, cuts[1:])]
    words.learn(set(pieces))
    pieces = list(map(words.__getitem__, pieces))
    return [b"".join(pieces[a:b]) for a, b in zip(before.tolist(), before[1:].tolist())]


def _encode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text to doc_id, n_bytes, ids, offsets."""
    ranks = read_ranks(path)
    words = Words(ranks)
    width = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    for token, rank in ranks.items():
        width[rank] = len(token)
    for batch in chunks(batches):
        ids = encode_texts(batch.column(1).to_pylist(), words)
        offsets, sizes = [], []
        for packed in ids:
            lengths = width[np.frombuffer(packed, "<u4")]
            ends = np.cumsum(lengths)
            offsets.append((ends - lengths).astype("<u4").tobytes())
            sizes.append(int(ends[-1]) if len(ends) else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
             pa.array(offsets, pa.binary())],
            ["doc_id", "n_bytes", "ids", "offsets"],
        )


def _decode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_encode`` gives, with the decoded bytes."""
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values(), default=0) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    width = np.fromiter(map(len, tokens), np.int64, len(tokens))
    first = np.cumsum(width) - width
    table = np.frombuffer(b"".join(tokens), np.uint8)
    for batch in batches:
        decoded = []
        for size, packed, places in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            ids = np.frombuffer(packed, "<u4")
            at = np.frombuffer(places, "<u4").astype(np.int64)
            shift = np.repeat(first[ids] - at, width[ids])
            decoded.append(table[shift + np.arange(size)].tobytes())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
        )


ENCODED = "doc_id long, n_bytes long, ids binary, offsets binary"


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def encode(documents: DataFrame, path: str) -> DataFrame:
    """Token ids of every whole text under the vocabulary at ``path``, without special tokens.

    Returns doc_id, n_bytes (of the UTF-8 text), ids and offsets: both packed as little-endian
    unsigned 32-bit integers, ids of the tokens and the byte of the text at which each starts. A
    null or empty text has no ids. Rows stay as they are, repeated or not; other columns are not
    read; an empty table gives an empty table. Each row is encoded alone, half a megabyte (or one
    longer text) at a time. ``path`` must be readable on the executors.
    """
    return _texts(documents).mapInArrow(partial(_encode, path), ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The bytes of encoded documents: each token's bytes are put at the offset kept for it.

    Takes and keeps what ``encode`` returns, and adds ``decoded`` (binary). No ids give no bytes.
    """
    rows = encoded.select("doc_id", "n_bytes", "ids", "offsets")
    return rows.mapInArrow(partial(_decode, path), f"{ENCODED}, decoded binary")


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """``decode`` of ``encode`` in one pass over the texts, by one worker a task."""
    return _texts(documents).mapInArrow(
        lambda batches: _decode(path, _encode(path, batches)), f"{ENCODED}, decoded binary"
    )
