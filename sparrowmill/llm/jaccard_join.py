"""N-gram Jaccard join: a MinHash LSH forest finds families, all pairs in a family are verified.

1. Every text becomes the set of its five-word shingles and a signature: TREES labels of DEPTH
   minimum hashes. Equal word sequences are one representative from here on.
2. A tree's labels form a prefix trie. The matched prefix is shortened from DEPTH until pairs at the
   threshold share one in some tree with the target recall; representatives with that prefix meet in
   a bucket. Inside a bucket, sorted by label, prefixes are shortened one value at a time: what deeper
   nodes have joined is not compared again, the rest is compared by whole signatures. A bucket gives
   at most one link per member, not its pairs.
3. The links' connected components are families. All pairs inside a family are verified exactly by
   matrix products over its shingles, in tiles of bounded size, which also finds pairs that no bucket
   held. Tiles give sums per representative and again one link per member.
4. Classes are the components of the verified links.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.common import chunks, free, runs, stored, text_of
from sparrowmill.llm.components import components
from sparrowmill.operators.skew import apart

SHINGLE = 5
TREES, DEPTH = 24, 6
BUCKET_ROWS = 1024  # members of a bucket compared in one tile's side
FAMILY_ROWS, FAMILY_SHINGLES = 512, 1 << 20  # one side of a family's tile
CACHE_WORDS = 150_000
SEED = 20240602

_WORD = re.compile(r"[^\W_]+")


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingle_hashes(words: list[str], known: WordHashes) -> np.ndarray:
    """64-bit hashes of the shingles in order; the whole text is one if it has fewer than five words."""
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if not len(each):
        return each
    width = min(SHINGLE, len(each))
    out = np.full(len(each) - width + 1, width, np.uint64)
    for i in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + each[i : i + len(out)])
    return out


def multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(shingles: list[np.ndarray], count: int) -> np.ndarray:
    """(texts, count) minimum hashes, 16 bits of each; every text has a shingle."""
    joined = np.concatenate(shingles)
    sizes = np.fromiter(map(len, shingles), np.int64, len(shingles))
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(shingles), count), np.uint16)
    for k, a in enumerate(multipliers(count)):
        least = np.minimum.reduceat((joined * a) >> np.uint64(20), starts)
        out[:, k] = mixed(least).astype(np.uint16)
    return out


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix that a pair at the threshold shares in some tree with that probability."""
    for length in range(depth, 1, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    return 1


def link_bucket(signature: np.ndarray, label: np.ndarray, shortest: int, least: float) -> list[tuple[int, int]]:
    """Links that join the members of a bucket whose signatures agree in a share ``least`` or more,
    directly or by way of others. Deep prefixes are joined first."""
    order = np.lexsort(label.T[::-1])
    signature, label = signature[order], label[order]
    shared = np.cumprod(label[1:] == label[:-1], axis=1).sum(axis=1)
    root, links = np.arange(len(order)), []
    for length in range(label.shape[1], shortest - 1, -1):
        cuts = [0, *(np.flatnonzero(shared < length) + 1).tolist(), len(order)]
        for start, stop in zip(cuts, cuts[1:]):
            if stop - start < 2 or (root[start:stop] == root[start]).all():
                continue
            for i in range(start, stop - 1):
                others = np.flatnonzero(root[i + 1 : stop] != root[i]) + i + 1
                if not len(others):
                    continue
                near = (signature[others] == signature[i]).mean(axis=1) >= least
                for j in others[near].tolist():
                    if root[j] != root[i]:
                        root[root == root[j]] = root[i]
                        links.append((int(order[i]), int(order[j])))
    return links


def common_counts(shingles: list[np.ndarray]) -> np.ndarray:
    """Numbers of common shingles of all pairs, as a matrix; each text's shingles are distinct."""
    owner = np.repeat(np.arange(len(shingles)), list(map(len, shingles)))
    values, place, counts = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    used = counts > 1
    column = np.cumsum(used) - 1
    keep = used[place]
    owner, place = owner[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    common = np.zeros((len(shingles), len(shingles)), np.float64)
    width = 4096
    for start in range(0, int(used.sum()), width):
        lo, hi = np.searchsorted(place, [start, start + width])
        part = np.zeros((len(shingles), width), np.float32)
        part[owner[lo:hi], place[lo:hi] - start] = 1
        common += part @ part.T  # whole numbers up to 4096: exact
    return common.astype(np.int64)


def _tiles(rows: DataFrame, keys: list[str], blocks, salt) -> DataFrame:
    """Rows with the pairs (lo, hi) of blocks of their group that they belong to; ``block`` is theirs."""
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(salt, F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    rows = rows.withColumn("other", other)
    return rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))


def near_classes(
    documents: DataFrame, threshold: float = 0.8, recall: float = 0.9999, trees: int = TREES, depth: int = DEPTH
) -> DataFrame:
    """Every document's near-duplicate class and its number of links.

    Two documents are linked when the Jaccard similarity of their sets of five-word shingles is at
    least ``threshold``. Words are runs of letters and digits in lower case; a text of one to four
    words is one shingle; a text without words (null, empty) is linked to nothing. Returns doc_id,
    class_id (least doc_id of the documents that links connect; its own without links) and n_links
    (other documents linked to it, copies included), a row per document row. Rows without doc_id take
    no part: their class_id is null and they have no links. Rows that repeat a doc_id count as rows.
    Other columns are not read; an empty table gives an empty table.

    Candidate families come from an LSH forest that misses a pair at the threshold with probability
    1 - ``recall``, and less above it; all links inside a family are verified exactly, none outside
    the threshold is returned.
    """
    count = trees * depth
    shortest = prefix_length(threshold, trees, depth, recall)
    # Five standard deviations below the threshold: signatures only choose what is verified.
    least = threshold - 5 * float(np.sqrt(threshold * (1 - threshold) / count))
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in chunks(batches):
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            names = [_digest(w) for w in words]
            full = [shingle_hashes(w, known) for w in words if w]
            found = iter([s.tobytes() for s in signatures(full, count)] if full else [])
            signed = [next(found) if w else None for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.binary()), pa.array(signed, pa.binary())],
                ["doc_id", "same", "signature"],
            )

    docs = stored(base.mapInArrow(read, "doc_id long, same binary, signature binary"))
    known = docs.where("doc_id IS NOT NULL AND same IS NOT NULL")
    reps = stored(
        known.groupBy("same")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("signature").alias("signature"))
        .withColumn("rep", F.monotonically_increasing_id())
    )

    links = _forest_links(reps, trees, depth, shortest, least)
    families = stored(components(links))
    sums = _verified(base, reps, families, threshold)
    linked = stored(sums)
    classes = components(linked.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    counted = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    small = reps.select("rep", "same", "first_id", "copies")
    rooted = stored(
        small.join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counted, "rep", "left")
        .select("same", "first_id", F.coalesce("root", "rep").alias("root"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    # One class may hold most of the texts; set apart, the least ids let its partition be split.
    result = stored(rooted.join(apart(named), "root").select("same", "class_id", "n_links"))
    whole = docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("same")).alias("same"))
    return whole.join(result, "same", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def one_of_each_class(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents, with their columns, that have the least doc_id of their near-duplicate class.

    Rows that repeat both doc_id and text are one document. Rows without doc_id have no class and
    stay, as do texts without words.
    """
    kept = near_classes(documents, threshold).where("doc_id = class_id").select("class_id").distinct()
    kept = kept.withColumnRenamed("class_id", (name := free(documents, "class_id")[0]))
    known = documents.where("doc_id IS NOT NULL").join(
        kept, F.col("doc_id").cast("long") == F.col(name), "left_semi"
    )
    return known.dropDuplicates(["doc_id", "text"]).unionByName(documents.where("doc_id IS NULL"))


def _digest(words: list[str]) -> bytes | None:
    return hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest() if words else None


def _forest_links(reps: DataFrame, trees: int, depth: int, shortest: int, least: float) -> DataFrame:
    """(a, b): links that connect the members of every bucket whose signatures are near."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                packed = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16)
                labels = packed.reshape(part.num_rows, trees, depth)[:, :, :shortest].astype(np.uint64)
                key = np.tile(np.arange(trees, dtype=np.uint64), (part.num_rows, 1))
                for i in range(shortest):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + labels[:, :, i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)),
                     pa.array(np.tile(np.arange(trees, dtype=np.int32), part.num_rows)),
                     pa.array(np.repeat(part.column(0).to_numpy(), trees))],
                    ["key", "tree", "rep"],
                )

    keyed = stored(reps.select("rep", "signature").mapInArrow(keys, "key long, tree int, rep long"))
    shared = stored(keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"))
    members = keyed.join(shared, "key").join(reps.select("rep", "signature"), "rep")
    tiles = _tiles(members, ["key"], F.ceil(F.col("members") / BUCKET_ROWS).cast("int"), F.xxhash64("rep"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for run in runs(batches, 3):
            if run.num_rows < 2:
                continue
            ids, tree = run.column(4).to_pylist(), run.column(3)[0].as_py()
            rows = np.frombuffer(b"".join(run.column(5).to_pylist()), np.uint16).reshape(len(ids), -1)
            for i, j in link_bucket(rows, rows[:, tree * depth : (tree + 1) * depth], shortest, least):
                left.append(ids[i])
                right.append(ids[j])
            if len(left) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["a", "b"])
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    ordered = tiles.select("key", "lo", "hi", "tree", "rep", "signature").repartition("key", "lo", "hi")
    return ordered.sortWithinPartitions("key", "lo", "hi").mapInArrow(link, "a long, b long")


def _verified(base: DataFrame, reps: DataFrame, families: DataFrame, threshold: float) -> DataFrame:
    """(rep, other, links): sums of linked documents (other null) and links that join the classes."""
    wanted = families.join(reps.select("rep", "same", "first_id", "copies"), families["node"] == F.col("rep"))
    texts = wanted.select("root", "rep", "same", "first_id", "copies").join(
        base.where("doc_id IS NOT NULL"), F.col("first_id") == F.col("doc_id")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in chunks(batches):
            keep, sets = [], []
            for i, (text, same) in enumerate(zip(batch.column(4).to_pylist(), batch.column(3).to_pylist())):
                words = words_of(text)
                if _digest(words) == same:  # another row of the same id may have another text
                    keep.append(i)
                    sets.append(np.unique(shingle_hashes(words, known)))
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(list(map(len, sets)), pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["root", "rep", "copies", "size", "shingles"],
            )

    sets = stored(
        texts.select("root", "rep", "copies", "same", "text")
        .mapInArrow(read, "root long, rep long, copies long, size long, shingles binary")
        .dropDuplicates(["rep"])
    )
    sizes = stored(sets.groupBy("root").agg(F.count("*").alias("members"), F.sum("size").alias("all")))
    blocks = F.greatest(F.ceil(F.col("members") / FAMILY_ROWS), F.ceil(F.col("all") / FAMILY_SHINGLES))
    tiles = _tiles(sets.join(sizes, "root"), ["root"], F.least(blocks, F.col("members")).cast("int"), F.xxhash64("rep"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, 3):
            ids = run.column(3).to_pylist()
            if len(ids) < 2:
                continue
            lo, hi = run.column(1)[0].as_py(), run.column(2)[0].as_py()
            copies, block = run.column(4).to_numpy(), run.column(5).to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in run.column(6).to_pylist()]
            common = common_counts(sets)
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            linked = common / (size[:, None] + size[None, :] - common) >= threshold
            np.fill_diagonal(linked, False)
            if lo != hi:  # pairs inside a block are its own tile's
                linked &= block[:, None] != block[None, :]
            root, left, right = np.arange(len(ids)), [], []
            for i in range(len(ids)):
                for j in np.flatnonzero(linked[i] & (root != root[i])).tolist():
                    if root[j] != root[i]:
                        root[root == root[j]] = root[i]
                        left.append(ids[i])
                        right.append(ids[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids + left, pa.int64()), pa.array([None] * len(ids) + right, pa.int64()),
                 pa.array([*(linked @ copies).tolist(), *[0] * len(left)], pa.int64())],
                ["rep", "other", "links"],
            )

    ordered = tiles.select("root", "lo", "hi", "rep", "copies", "block", "shingles").repartition("root", "lo", "hi")
    return ordered.sortWithinPartitions("root", "lo", "hi").mapInArrow(verify, "rep long, other long, links long")
