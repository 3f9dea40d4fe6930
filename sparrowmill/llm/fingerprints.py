"""Document fingerprints: minimum hashes of the phrases a Lempel-Ziv parse finds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sparrowmill.llm.common import chunks, text_of

SLOTS = 128
EMPTY = 0xFFFF
MASK = (1 << 64) - 1
PART_BYTES = 16 << 20  # text per task
NO_ID = -(1 << 63)  # documents without id come last in descending order


class Parse:
    """An LZ78 parse that can go on from where it is, and be taken back.

    A phrase is the longest phrase known so far plus one byte. ``hashes`` has a 64-bit hash of each
    phrase, in the order found; phrase 0 is the empty one and does not count.
    """

    def __init__(self):
        self.phrases: dict[int, int] = {}
        self.hashes: list[int] = [0x9E3779B97F4A7C15]
        self.keys: list[int] = []
        self.at = 0

    def feed(self, data: bytes) -> None:
        phrases, hashes, keys, at = self.phrases, self.hashes, self.keys, self.at
        known = phrases.get
        for byte in data:
            key = at << 8 | byte
            at = known(key, 0)
            if not at:
                phrases[key] = len(hashes)
                hashes.append(((hashes[key >> 8] ^ byte) * 0x9FB21C651E98DF25 + 0x632BE59BD9B4E019) & MASK)
                keys.append(key)
        self.at = at

    def mark(self) -> tuple[int, int]:
        return len(self.keys), self.at

    def back(self, mark: tuple[int, int]) -> None:
        known, self.at = mark
        for key in self.keys[known:]:
            del self.phrases[key]
        del self.keys[known:]
        del self.hashes[known + 1 :]

    def signature(self) -> np.ndarray:
        """The least hash in each of SLOTS classes of hashes, mixed and cut to 16 bits; EMPTY without one.

        Of many phrases the least hash is small, so its own upper bits would tell little.
        """
        h = np.array(self.hashes[1:], np.uint64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        slot = (h % np.uint64(SLOTS)).astype(np.int64)
        least = np.full(SLOTS, MASK, np.uint64)
        np.minimum.at(least, slot, h)
        least ^= least >> np.uint64(33)
        least *= np.uint64(0xFF51AFD7ED558CCD)
        least ^= least >> np.uint64(33)
        least *= np.uint64(0xC4CEB9FE1A85EC53)
        # Scaled to 0 .. EMPTY - 1 from the upper 24 bits.
        value = (least >> np.uint64(40)) * np.uint64(EMPTY) >> np.uint64(24)
        filled = np.zeros(SLOTS, bool)
        filled[slot] = True
        return np.where(filled, value, np.uint64(EMPTY)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases, 0 to 1: equal slots among those that either one fills."""
    filled = (a != EMPTY) | (b != EMPTY)
    if not filled.any():
        return 1.0
    return float((a[filled] == b[filled]).mean())


def fingerprint(text: str) -> np.ndarray:
    parse = Parse()
    parse.feed(text.encode())
    return parse.signature()


class Edited:
    """A text's signature, and its parse set back to where the edit begins."""

    def __init__(self, text: str):
        self.text, self.edit = text, len(text) - len(text) // 3
        self.parse = Parse()
        self.parse.feed(text[: self.edit].encode())
        mark = self.parse.mark()
        self.parse.feed(text[self.edit :].encode())
        self.signature = self.parse.signature()
        self.parse.back(mark)

    def replaced(self, following: str) -> tuple[str, np.ndarray]:
        """The edited text and its signature; once only, as the parse goes on."""
        start = following[: len(self.text) // 3]
        self.parse.feed(start.encode())
        return self.text[: self.edit] + start, self.parse.signature()


def with_successor(documents: DataFrame) -> DataFrame:
    """doc_id, text and order columns, dealt so that the next document is in the same task.

    Cuts between tasks are ids that occur. The document at a cut goes to its own task, where it comes
    first, and once more as a guest to the task before. Sorted by task and then descending id.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    ).withColumn("rank", F.coalesce("doc_id", F.lit(NO_ID)))
    size = rows.agg(F.sum(F.octet_length("text")), F.max("rank")).head()
    # Up to 20,000 tasks, larger ones beyond that: a task streams its sorted rows.
    parts = min(20_000, max(1, -(-(size[0] or 0) // PART_BYTES)))
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("rank", shares, 20 * parts)).head()[0] if shares else []
    cuts = np.array(sorted(set(found or []) - {size[1]}, reverse=True), np.int64)

    @pandas_udf("array<int>")
    def places(rank: pd.Series) -> pd.Series:
        """Twice the task, plus one as a guest. A cut's own id opens its task."""
        ranks = rank.to_numpy()
        own = np.searchsorted(~cuts, ~ranks, side="right")  # both descend
        out = [[2 * t, 2 * t - 1] if g else [2 * t] for t, g in zip(own.tolist(), np.isin(ranks, cuts))]
        for i in np.flatnonzero(ranks == size[1]):
            out[i].append(2 * len(cuts) + 1)  # the first document follows the last
        return pd.Series(out)

    dealt = rows.withColumn("place", F.explode(places("rank")))
    dealt = dealt.withColumn("task", F.shiftright("place", 1)).withColumn("guest", F.col("place") % 2 == 1)
    # By the task's number, not by a hash of it: hashes would put several tasks' texts into one.
    return dealt.repartitionById(len(cuts) + 1, F.col("task")).sortWithinPartitions(
        "task", "guest", F.col("rank").desc(), "text"
    )


def compare_edited(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    The edited text has the last floor(n / 3) of the document's n code points replaced by the first
    as many of the next document in descending doc_id (the largest id follows the smallest), or all
    of it if it is shorter. A null text is empty; documents without doc_id come last; rows that
    repeat a doc_id follow each other in the order of their texts; a table of one document is its own
    successor; an empty table gives an empty table. Other columns are not read.

    Returns doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (hexadecimal),
    near_edited and near_next: likeness of the document's fingerprint to the edited text's and to the
    next document's. Empty texts have the fingerprint of no phrases and are like each other (1.0).

    A document is parsed once: the edited text begins like it, so its parse goes on from the place of
    the edit. Texts are shuffled once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                 "near_edited", "near_next"]
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        held, task, whole, out = None, None, False, []
        for batch in chunks(batches):
            for doc_id, text, at, guest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at != task:
                    held, task, whole = None, at, False
                if whole:
                    continue  # more guests: rows of the same id as the first
                own = Edited(text)
                if held is not None:
                    last_id, last = held
                    edited, other = last.replaced(text)
                    out.append((last_id, len(last.text), hashlib.sha256(edited.encode()).hexdigest(),
                                last.signature.tobytes().hex(), other.tobytes().hex(),
                                likeness(last.signature, other), likeness(last.signature, own.signature)))
                held, whole = (doc_id, own), guest
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names
                )
                out = []

    dealt = with_successor(documents).select("doc_id", "text", "task", "guest")
    return dealt.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
