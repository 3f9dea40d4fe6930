"""Line dedup: two Bloom filters pick suspected repeats, an exact shuffle confirms them.

The first pass builds two Bloom filters over the keys of all lines, one of keys seen at least once
and one of keys seen in at least two documents. Filters of two tasks merge into

    once = a.once | b.once        twice = a.twice | b.twice | (a.once & b.once)

which is associative and commutative, and misses no key: a key of two documents has all its bits
either in one side's ``twice`` or in both sides' ``once``. Only keys that the ``twice`` filter
holds, repeats plus a few false positives, are shuffled, as 32-byte digests, to count their
documents exactly and to choose the document that keeps them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.llm.common import chunks, free, merge_slabs, stored, text_of, total

HASHES = 4
SLAB_BYTES = 1 << 14
MIN_BITS, MAX_BITS = 1 << 20, 1 << 30  # the broadcast filter has 128 KiB to 128 MiB


def line_key(line: bytes) -> bytes:
    """Without [\\x20\\x09-\\x0D] at the ends, A-Z in lower case; other characters stay."""
    return line.strip().lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (
        len(key) >= 4 * min_chars or key.isascii() or len(key.decode()) >= min_chars
    )


def digests_of(text: str, min_chars: int) -> list[bytes]:
    """SHA-256 of the key of each line that counts, in line order."""
    keys = map(line_key, text.encode().split(b"\n"))
    return [hashlib.sha256(k).digest() for k in keys if long_enough(k, min_chars)]


def bit_positions(digests: list[bytes], bits: int) -> np.ndarray:
    """(digests, HASHES) positions by double hashing."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (words[:, :1] + steps * (words[:, 1:2] | np.uint64(1))) & np.uint64(bits - 1)


def _all_set(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bitmap[at >> 3] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(bitmap, flat >> 3, np.uint8(1) << (flat & np.uint64(7)).astype(np.uint8))


def merge_filters(left: bytes, right: bytes) -> bytes:
    """Two tasks' slabs, each packed as once + twice."""
    a, b = (np.frombuffer(zlib.decompress(x), np.uint8).reshape(2, -1) for x in (left, right))
    both = np.stack([a[0] | b[0], a[1] | b[1] | (a[0] & b[0])])
    return zlib.compress(both.tobytes(), 1)


def seen_twice(documents: DataFrame, min_chars: int, bits: int) -> np.ndarray:
    """The merged filter of keys that two or more documents hold, as a bitmap of ``bits`` bits."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in chunks(batches):
            # A document counts once for each of its keys.
            held = [d for t in batch.column(0).to_pylist() for d in set(digests_of(t, min_chars))]
            if not held:
                continue
            names, counts = _counted(held)
            at = bit_positions(names, bits)
            _set(twice, at[_all_set(once, at) | (counts > 1)])
            _set(once, at)
        slabs = np.stack([once, twice]).reshape(2, -1, min(SLAB_BYTES, bits // 8))
        used = np.flatnonzero(slabs[0].any(axis=1))
        for start in range(0, len(used), 256):
            some = used[start : start + 256]
            parts = [zlib.compress(slabs[:, s].tobytes(), 1) for s in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(parts, pa.binary())], ["slab", "part"]
            )

    rows = documents.select("text").mapInArrow(build, "slab int, part binary")
    result = np.zeros(bits // 8, np.uint8)
    width = min(SLAB_BYTES, bits // 8)
    for slab, part in merge_slabs(rows, merge_filters).items():
        result[slab * width : (slab + 1) * width] = np.frombuffer(
            zlib.decompress(part), np.uint8
        ).reshape(2, -1)[1]
    return result


def _counted(held: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    counts: dict[bytes, int] = {}
    for digest in held:
        counts[digest] = counts.get(digest, 0) + 1
    return list(counts), np.fromiter(counts.values(), dtype=np.int64)


def repeated_lines(documents: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, digests): for each document that loses lines, the digests of their keys."""
    held = documents.select("doc_id", text_of().alias("text")).where("doc_id IS NOT NULL")
    # About a bit for eight bytes of text: 16 bits a key when lines have 128 bytes. A filter too
    # small for its table only raises the number of suspects, never changes the result.
    size = total(held, F.octet_length("text"))
    bits = 1 << int(np.ceil(np.log2(min(max(size // 8, MIN_BITS), MAX_BITS))))
    bitmap = documents.sparkSession.sparkContext.broadcast(seen_twice(held, min_chars, bits))

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, out_ids, out = batch.column(0).to_pylist(), [], []
            for doc_id, text in zip(ids, batch.column(1).to_pylist()):
                found = list(set(digests_of(text, min_chars)))
                out_ids += [doc_id] * len(found)
                out += found
            if out:
                hit = pa.array(_all_set(bitmap.value, bit_positions(out, bits)))
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(out_ids, pa.int64()), pa.array(out, pa.binary())],
                    ["doc_id", "digest"],
                )
                yield rows.filter(hit)

    suspects = stored(held.mapInArrow(suspect, "doc_id long, digest binary"))
    # Repeated rows of one id are one document; the id is part of the second key only.
    docs_of = suspects.groupBy("digest", "doc_id").agg(F.lit(1).alias("n"))
    confirmed = stored(
        docs_of.groupBy("digest")
        .agg(F.sum("n").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("digest", "keeper")
    )
    return (
        suspects.join(confirmed, "digest")
        .where(F.col("doc_id") < F.col("keeper"))
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("digests"))
    )


def _stripped(documents: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """All columns, then the text without its shared lines, the number of its lines and of those that go,
    under names of their own."""
    rank, whole, drop, lines_, dropped_ = free(documents, "__id", "__text", "__drop", "__lines", "__dropped")
    drops = repeated_lines(documents, min_chars, min_docs).withColumnsRenamed(
        {"doc_id": rank, "digests": drop}
    )
    base = documents.select(
        "*", F.col("doc_id").cast("long").alias(rank), text_of().alias(whole)
    ).join(drops, rank, "left")
    columns = [*documents.columns, whole, drop]

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, whole):
            kept, lines, dropped = [], [], []
            texts, digests = (c.to_pylist() for c in batch.columns[-2:])
            for text, gone in zip(texts, digests):
                if gone is None:
                    kept.append(text)
                    lines.append(text.count("\n") + 1)
                    dropped.append(0)
                    continue
                gone, stay, n = set(gone), [], 0
                for line in text.encode().split(b"\n"):
                    n += 1
                    key = line_key(line)
                    if not (long_enough(key, min_chars) and hashlib.sha256(key).digest() in gone):
                        stay.append(line)
                kept.append(b"\n".join(stay).decode())
                lines.append(n)
                dropped.append(n - len(stay))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(kept, pa.string()),
                 pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                [*batch.schema.names[:-2], whole, lines_, dropped_],
            )

    schema = T.StructType([
        *documents.schema.fields, T.StructField(whole, T.StringType()),
        T.StructField(lines_, T.LongType()), T.StructField(dropped_, T.LongType()),
    ])
    return base.select(*[f"`{c}`" for c in columns]).mapInArrow(strip, schema)


def dedup_lines(documents: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Documents without the lines that at least ``min_docs`` documents share.

    A line is what stands between two \\n; a null or empty text is one empty line. Lines are equal
    when their keys (``line_key``) are. Keys of ``min_chars`` code points or more that occur in
    ``min_docs`` documents or more lose all their lines, except in the document with the largest
    doc_id among those that hold them, where all stay.

    Returns doc_id, text (the kept lines joined by \\n; empty for null), n_lines (before), n_dropped;
    other columns are not read. A document without doc_id has no rank: it counts for no key and
    stays whole. Rows that repeat a doc_id are one document. An empty table gives an empty table.
    A document's own line digests travel as one set, so it is bounded by that document's length.
    """
    stripped = _stripped(documents.select("doc_id", "text"), min_chars, min_docs)
    text, lines, dropped = stripped.columns[-3:]
    return stripped.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.col(lines).alias("n_lines"), F.col(dropped).alias("n_dropped"),
    )


def without_shared_lines(documents: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with all their columns; ``text`` (and ``n_chars``, where there is one) of those
    that ``dedup_lines`` changes is what it leaves. Null texts stay null. Columns may have any names."""
    stripped = _stripped(documents, min_chars, min_docs)
    text, _, dropped = stripped.columns[-3:]
    changed = F.col(dropped) > 0
    new = {"text": F.col(text), "n_chars": F.length(text)}
    return stripped.select(*[
        F.when(changed, new[f.name].cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in new else F.col(f"`{f.name}`")
        for f in documents.schema.fields
    ])
