"""Packing token sequences: bounded-space online best-fit over whole documents."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.common import chunks, stored, text_of

END_ID = 0
OPEN_BINS = 2048
PIECES_PER_TASK = 250_000


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable Latin-1 characters
    for themselves, the other bytes in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """An encoder with the ids of the tokenizer file at ``path``, special tokens taken as text.

    Byte-level merges run in rank order, which is what the file's merge list says too; the tests
    compare the ids with those of the file's own library, code point by code point.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    byte = printable_bytes()
    ranks = {
        bytes(byte[c] for c in token): rank
        for token, rank in spec["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def cut_document(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only a longer one is cut, its first piece shorter."""
    if length <= size:
        return [(0, length)]
    first = length % size or size
    return [(0, first), *((at, size) for at in range(first, length, size))]


class Bins:
    """A fixed number of open sequences, found by free space through a bitset.

    ``put`` places a piece in the open sequence with the least free space that still holds it; if
    none does, it opens one, and closes the fullest if that makes too many.
    """

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = 0
        self.open = 0
        self.made = 0

    def _take(self, space: int) -> int:
        bins = self.free[space]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << space
        return number

    def put(self, length: int) -> tuple[int, int]:
        """(sequence number, offset in it)."""
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            number, space = self.made, self.size
            self.made += 1
            self.open += 1
        left = space - length
        if left:
            self.free[left].append(number)
            self.bits |= 1 << left
        else:
            self.open -= 1
        if self.open > self.most:
            self._take((self.bits & -self.bits).bit_length() - 1)
            self.open -= 1
        return number, self.size - space


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows again, ``rows`` of them in a batch."""
    held, count = [], 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, rows - count)
            held.append(part)
            count, start = count + part.num_rows, start + part.num_rows
            if count == rows:
                yield pa.concat_batches(held)
                held, count = [], 0
    if held:
        yield pa.concat_batches(held)


def tokenized_pieces(documents: DataFrame, path: str, size: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and ids (packed) of every document's pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        for batch in chunks(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = np.append(ids_of.encode_to_numpy(text), END_ID).astype("<u4").tobytes()
                for piece, (start, length) in enumerate(cut_document(len(packed) // 4, size)):
                    part = packed[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(part), part))
            columns = list(zip(*rows))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def pack(
    documents: DataFrame, path: str, size: int = 2048, open_bins: int = OPEN_BINS, with_ids: bool = True
) -> DataFrame:
    """Every document's tokens in sequences of at most ``size`` tokens, as few as it can.

    A document is its text's ids and then id 0; null and empty texts have that one id. Only a
    document longer than a sequence is cut. Returns a row per piece: doc_id, piece, start (the
    document's ids before it), length, ids_crc32, sequence_id, offset (place in the sequence,
    gapless from 0), and ``ids`` (packed little-endian unsigned 32-bit integers) unless ``with_ids``
    is false. Rows that repeat a doc_id or have none are packed like any other; other columns are
    not read; an empty table gives an empty table.

    Pieces are dealt evenly over one task per PIECES_PER_TASK pieces, which the tables' keys do not
    influence, and each task packs its stream with ``open_bins`` open sequences, twice as many pieces
    at a time, the longest first. Memory is bounded by them: ``ids`` stay outside these tasks and meet
    their places by the number that a piece got when it was stored. What is lost against packing all
    pieces in one go is at most the free space of ``open_bins`` sequences a task.
    """
    pieces = tokenized_pieces(documents, path, size)
    columns = [c for c in pieces.columns if with_ids or c != "ids"]
    if with_ids:
        pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()))
        narrow = pieces.select("doc_id", "piece", "length", "row")
    else:
        pieces = narrow = stored(pieces.select(*columns))
    tasks = max(1, -(-pieces.count() // PIECES_PER_TASK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(size, open_bins)
        lane = TaskContext.get().partitionId() << 40
        for block in blocks(batches, 2 * open_bins):
            block = block.take(pc.sort_indices(block, [("length", "descending")]))
            placed = [bins.put(length) for length in block.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array([lane + n for n, _ in placed], pa.int64()),
                 pa.array([at for _, at in placed], pa.int64())],
                [*block.schema.names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"{n} {t}" for n, t in narrow.dtypes) + ", sequence_id long, offset long"
    # A mixed order: lengths arrive as in the whole table, whatever the order of the input.
    order = [c for c in ("doc_id", "piece", "row") if c in narrow.columns]
    mixed = narrow.repartition(tasks).sortWithinPartitions(F.xxhash64("doc_id", "piece"), *order)
    placed = mixed.mapInArrow(run, schema)
    if not with_ids:
        return placed
    return pieces.join(placed.select("row", "sequence_id", "offset"), "row").select(
        *columns, "sequence_id", "offset"
    )
