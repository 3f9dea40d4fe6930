"""Prefix trie of conversations by depth-first search over vertical bitmaps, shard by shard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.llm.common import positions, runs, stored
from sparrowmill.operators.skew import apart

# A conversation is cut into blocks of so many depths, so that no task holds a long one whole.
BLOCK = 4096
# One shard's bitmaps are over at most so many conversations, with about so many turns.
SHARD_CONVERSATIONS, SHARD_TURNS = 4096, 50_000
ROOT = bytes(16)
NOTHING_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), key (digest of role and text), words (of the text).

    Turns stand in the order of ``turn``, null first; those of one number in the order of their digests.
    A null role or text is empty. Rows without a conv_id belong to no conversation and are left out.
    The order is one sort over all executors, so a conversation of any length is numbered.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    spelt = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(F.encode(spelt, "UTF-8"), 256)), 1, 16).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key")]
    placed = stored(positions(turns, order).drop("turn"))
    first = placed.groupBy("conv_id").agg(F.min("position").alias("first"))
    joined = placed.join(apart(first), "conv_id")
    return joined.select("conv_id", (F.col("position") - F.col("first") + 1).alias("place"), "key", "words")


def with_borrowed_starts(turns: DataFrame, family: int = 20, kinds: int = 4) -> DataFrame:
    """Conversations rebuilt from numbered turns: the first h turns of c come from conversation
    c - c % ``family``, where h is crc32 of the decimal c modulo ``kinds``; c's own first h turns go.

    Returns conv_id, place, length (turns of the conversation), key, words, and for every
    conversation a row with place 0 and no key: one may have no turn left. Of a conversation at most
    ``kinds`` - 1 turns are lent, to less than 2 * ``family`` others.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % kinds
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("own")).withColumns(
        {"h": h, "base": F.col("conv_id") - F.col("conv_id") % family}
    )
    lenders = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("lent"))
    whole = stored(
        sizes.join(lenders, "base", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0))))
        .withColumn("length", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    own = turns.join(apart(whole), "conv_id").where("place > h").select(
        "conv_id", (F.col("lent") + F.col("place") - F.col("h")).alias("place"), "length", "key", "words"
    )
    starts = turns.where((F.col("place") < kinds) & (F.col("conv_id") % family == 0))
    lent = starts.withColumnRenamed("conv_id", "base").join(whole, "base").where("place <= h")
    roots = whole.select(
        "conv_id", F.lit(0).cast("long").alias("place"), "length",
        F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("words"),
    )
    return own.unionByName(lent.select(*own.columns)).unionByName(roots)


def _block(place: Column, block: int) -> Column:
    return F.floor(place / F.lit(block)).cast("long")


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """The turns with block, and for long conversations the keys of the nodes at a block's two ends.

    A node's key is a digest chained from turn to turn. At the end of a block it is made from sums over
    the turns so far instead, which all tasks can add up, so that the next block need not wait.
    """
    turns = turns.withColumn("block", _block(F.col("place"), block))
    nothing = F.lit(None).cast("binary")
    short = turns.where(F.col("length") < block - 1).withColumns({"start": nothing, "end": nothing})
    long = turns.where(F.col("length") >= block - 1)

    def total(salt: int) -> Column:
        return F.sum(F.xxhash64(F.lit(salt), "place", "key").cast("decimal(38,0)")).alias(f"s{salt}")

    order = Window.partitionBy("conv_id").orderBy("block")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(f"s{i}").over(so_far).cast("string") for i in (1, 2)]
    ends = (
        long.groupBy("conv_id", "block").agg(total(1), total(2))
        .withColumn("end", F.unhex(F.md5(F.concat_ws(":", "block", *sums).cast("binary"))))
        .withColumn("start", F.lag("end").over(order))
    )
    joined = long.join(ends.select("conv_id", "block", "start", "end"), ["conv_id", "block"])
    return short.unionByName(joined)


class Shard:
    """Vertical bitmaps over some conversations' turns in one block.

    Conversation i is bit i. ``postings`` has for each (place, turn) the set of conversations, ``ends``
    for each place those that end there. Sets are integers, so that an intersection is one ``&``.
    """

    def __init__(self, number: int, block: int):
        self.low, self.block = number * block, block  # the block's first place and its depths
        self.conversations: list[int] = []
        self.turns: list[list[tuple[bytes | None, int]]] = []
        self.bounds: list[tuple[bytes | None, bytes | None]] = []
        self.postings: dict[tuple[int, bytes | None], int] = {}
        self.ends: dict[int, int] = {}
        self.size = 0

    def add(self, unit: pa.RecordBatch) -> None:
        """One conversation's turns in the block, in order."""
        bit = 1 << len(self.conversations)
        names = ("place", "length", "key", "words")
        places, lengths, keys, words = (unit.column(c).to_pylist() for c in names)
        for place, key in zip(places, keys):
            self.postings[place, key] = self.postings.get((place, key), 0) | bit
        if lengths[0] == places[-1]:
            self.ends[places[-1]] = self.ends.get(places[-1], 0) | bit
        self.conversations.append(unit.column("conv_id")[0].as_py())
        self.turns.append(list(zip(keys, words)))
        self.bounds.append((unit.column("start")[0].as_py(), unit.column("end")[0].as_py()))
        self.size += len(keys)

    def members(self, which: int) -> list[int]:
        """The set's conversations in ascending order, as places in the shard."""
        if which.bit_count() == 1:
            return [which.bit_length() - 1]
        raw = np.frombuffer(which.to_bytes((which.bit_length() + 7) // 8, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()

    def roots(self) -> list[tuple[int, int, bytes | None]]:
        """(members, depth, key) of the nodes that the block's nodes hang from."""
        if not self.low:
            return [((1 << len(self.conversations)) - 1, -1, None)]
        sets: dict[bytes, int] = {}
        for i, (start, _) in enumerate(self.bounds):
            sets[start] = sets.get(start, 0) | 1 << i
        return [(which, self.low - 1, key) for key, which in sets.items()]

    def nodes(self) -> Iterator[tuple]:
        """(key, parent, depth, words, members, conversations that end there), depth first."""
        stack = self.roots()
        while stack:
            parents, depth, parent = stack.pop()
            rest, depth = parents & ~self.ends.get(depth, 0), depth + 1
            while rest:
                first = (rest & -rest).bit_length() - 1
                turn, words = self.turns[first][depth - self.low]
                inside = parents & self.postings[depth, turn]
                rest &= ~inside
                closing = (depth + 1) % self.block == 0
                if closing:
                    key = self.bounds[first][1]
                elif parent is None:
                    key = ROOT
                else:
                    key = hashlib.blake2b(parent + turn, digest_size=16).digest()
                members = [self.conversations[i] for i in self.members(inside)]
                ending = inside & self.ends.get(depth, 0)
                ending = [self.conversations[i] for i in self.members(ending)] if ending else []
                yield key, parent, depth, words, members, ending
                if not closing and len(members) > len(ending):
                    stack.append((inside, depth, key))


FOUND = (
    "key binary, parent binary, depth long, words long, n_convs long, conv_id long, ends binary, place long"
)


def _found(shard: Shard) -> Iterator[pa.RecordBatch]:
    """Rows of a shard's nodes, then a row per member of each node with only key, conv_id and place."""
    kinds = {"binary": pa.binary(), "long": pa.int64()}
    types = [(c.split()[0], kinds[c.split()[1]]) for c in FOUND.split(", ")]
    nodes, keys, who, where = [], [], [], []
    for key, parent, depth, words, members, ending in shard.nodes():
        packed = np.array(ending, "<i8").tobytes() if ending else None
        nodes.append((key, parent, depth, words, len(members), members[0], packed, None))
        keys += [key] * len(members)
        who += members
        where += [depth] * len(members)
    for columns in (
        dict(zip((n for n, _ in types), zip(*nodes))), {"key": keys, "conv_id": who, "place": where}
    ):
        size = len(columns["key"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in types],
            [n for n, _ in types],
        )


def _search(
    block: int, most: int, most_turns: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Whole units (block, conversation) into shards, each searched when it is full."""
    shard, number = None, None
    for unit in runs(batches, 2):
        here = unit.column("block")[0].as_py()
        if shard and (here != number or shard.size >= most_turns or len(shard.conversations) >= most):
            yield from _found(shard)
            shard = None
        if shard is None:
            shard, number = Shard(here, block), here
        shard.add(unit)
    if shard:
        yield from _found(shard)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its shards' lists, which arrive in ascending order."""
    last, digest = None, None
    for batch in batches:
        for key, packed in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            text = ",".join(map(str, np.frombuffer(packed, "<i8").tolist())).encode()
            if key == last:
                digest.update(b"," + text)
                continue
            if last is not None:
                yield pa.RecordBatch.from_pydict({"key": [last], "ends_sha256": [digest.hexdigest()]})
            last, digest = key, hashlib.sha256(text)
    if last is not None:
        yield pa.RecordBatch.from_pydict({"key": [last], "ends_sha256": [digest.hexdigest()]})


def _subtree_sums(members: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """key, n_leaves, saved_tokens of every node, without walking the tree.

    Each node's own share is written on its smallest member at its depth. What a node's subtree holds is
    then the sum over its members of the shares at its depth or deeper: all nodes below it have their
    smallest member among them. Shares are added up from the end of each block, and the later blocks'
    totals are carried in.
    """
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    shares = nodes.select(
        F.lit(None).cast("binary").alias("key"), "conv_id", F.col("depth").alias("place"),
        leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    nothing = F.lit(0).cast("long")
    rows = members.select("key", "conv_id", "place", nothing.alias("leaves"), nothing.alias("saved"))
    rows = rows.unionByName(shares).withColumn("block", _block(F.col("place"), block))
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    per_block = rows.groupBy("conv_id", "block").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    carried = per_block.select(
        F.lit(None).cast("binary").alias("key"), "conv_id", F.lit(2**62).alias("place"),
        F.sum("leaves").over(later).alias("leaves"), F.sum("saved").over(later).alias("saved"), "block",
    ).where("leaves is not null")
    below = Window.partitionBy("conv_id", "block").orderBy(F.desc("place"))
    added = rows.unionByName(carried).select(
        "key", F.sum("leaves").over(below).alias("leaves"), F.sum("saved").over(below).alias("saved")
    )
    return added.where("key is not null").groupBy("key").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )


def prefix_trie(
    turns: DataFrame, block: int = BLOCK, most: int = SHARD_CONVERSATIONS, most_turns: int = SHARD_TURNS
) -> DataFrame:
    """The trie of conversations: a row per distinct sequence of first turns, the empty one included.

    ``turns`` has conv_id, place (0 for the row that every conversation has, then 1, 2, ... without
    gaps), length, key (what tells turns apart, 16 bytes), words. Returns node (16 bytes), parent (null
    for the root), conv_id (smallest member), parent_conv_id, depth, n_convs, n_children, n_leaves (of
    the subtree, which includes its top), saved_tokens (summed over the subtree: members but one, times
    the words of the last turn) and ends_sha256 (of the decimal ids of the members that end there, in
    ascending order, comma-joined). No conversations give no rows, not even a root.

    Conversations are cut into blocks of ``block`` depths and dealt by ranges of (block, conv_id), so that
    neither a long conversation nor a common turn decides what a task holds. A shard has at most ``most`` conversations and about ``most_turns``
    turns. Each shard gives nodes with counts and lists of ends; nodes of one key are then added up over the shards. Sequences
    are told apart by 128-bit digests. The list of ends of one node is hashed in one task, since
    SHA-256 goes from front to back; it streams packed lists, one a shard, and holds one at a time.
    """
    units = _blocks(turns, block).select("block", "conv_id", "place", "length", "key", "words", "start", "end")
    dealt = units.repartitionByRange("block", "conv_id").sortWithinPartitions("block", "conv_id", "place")
    found = stored(dealt.mapInArrow(partial(_search, block, most, most_turns), FOUND))
    parts, members = found.where("place is null"), found.where("place is not null")
    merged = stored(
        parts.groupBy("key", "parent", "depth", "words")
        .agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    )
    children = merged.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"))
    nodes = merged.join(children.withColumnRenamed("parent", "key"), "key", "left").fillna(0, ["n_children"])
    ends = (
        parts.where("ends is not null").select("key", "conv_id", "ends").repartition("key")
        .sortWithinPartitions("key", "conv_id").select("key", "ends")
        .mapInArrow(_hash_ends, "key binary, ends_sha256 string")
    )
    parents = apart(merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")))
    return (
        nodes.join(_subtree_sums(members, nodes, block), "key")
        .join(ends, "key", "left").fillna(NOTHING_ENDS, ["ends_sha256"])
        .join(parents, "parent", "left")
        .select(F.col("key").alias("node"), "parent", "conv_id", "depth", "parent_conv_id", "n_convs",
                "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )
