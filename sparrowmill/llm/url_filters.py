"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.common import merge_slabs
from sparrowmill.operators.skew import apart

BLOCK_BYTES = 64  # one cache line: all bits of a key are in one block
KEY_BITS = 8
MIN_BLOCKS, MAX_BLOCKS = 1 << 8, 1 << 21  # the broadcast filter has 16 KiB to 128 MiB
SLAB_BYTES = 1 << 14


def bit_places(keys: list[str], blocks: int) -> np.ndarray:
    """(keys, KEY_BITS) bit positions: a block each, and bits in that block."""
    raw = b"".join(hashlib.blake2b(k.encode(), digest_size=16).digest() for k in keys)
    words = np.frombuffer(raw, "<u8").reshape(-1, 2)
    block = words[:, :1] % np.uint64(blocks)
    shifts = np.arange(KEY_BITS, dtype=np.uint64) * np.uint64(8)
    # Nine bits from each byte and its neighbour choose a place among the block's 512.
    inside = (words[:, 1:] >> shifts | words[:, 1:] << (np.uint64(64) - shifts) % np.uint64(64)) & np.uint64(511)
    return (block * np.uint64(8 * BLOCK_BYTES) + inside).astype(np.int64)


def holds(bitmap: np.ndarray, keys: list[str]) -> np.ndarray:
    at = bit_places(keys, len(bitmap) // BLOCK_BYTES)
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def build_filter(rules: DataFrame) -> np.ndarray:
    """The filter of all rule keys, built on the executors and merged by bitwise or."""
    listed = rules.count()
    blocks = MIN_BLOCKS
    while blocks < MAX_BLOCKS and blocks * 8 * BLOCK_BYTES < 16 * listed:
        blocks *= 2
    size = blocks * BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(size, np.uint8)
        for batch in batches:
            if batch.num_rows:
                at = bit_places(batch.column(0).to_pylist(), blocks).ravel()
                np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))
        slabs = bitmap.reshape(-1, SLAB_BYTES)
        used = np.flatnonzero(slabs.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([slabs[s].tobytes() for s in used], pa.binary())],
            ["slab", "part"],
        )

    def either(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes()

    out = np.zeros(size, np.uint8)
    rows = rules.select("rule").mapInArrow(run, "slab int, part binary")
    for slab, part in merge_slabs(rows, either).items():
        out[slab * SLAB_BYTES : (slab + 1) * SLAB_BYTES] = np.frombuffer(part, np.uint8)
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first :// up to / ? # or the end, A-Z lower-cased; path up to ?
    or # or the end. Both empty without ://."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    stop = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:stop]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.encode().lower().decode(), path


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Canonical keys that could be listed: the host and its parent domains, each with the path's
    beginnings of the lengths that listed paths have."""
    if not host:
        return []
    parents = [host]
    while "." in parents[-1]:
        parents.append(parents[-1].partition(".")[2])
    starts = [path[:n] for n in lengths if n <= len(path)]
    return [p + s for p in parents if p for s in starts]


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The verdict on every page's URL.

    ``rules`` has verdict, host and path (path starts with /). A rule fits its host and all
    subdomains when the URL's path starts with the rule's; the longest fitting rule (host plus path,
    then the longer host) decides, else ``default``. Returns page_id, host, path, rule (host plus
    path of the deciding rule, else null) and verdict. A null URL, or one without ://, has empty
    host and path and takes the default; repeated pages are judged alike, one row each; other columns
    are not read; rules that repeat or are null are listed once or not at all, and of contradicting
    verdicts of one rule the larger text (block) holds.

    Every URL is probed in its own task. Only distinct (host, path) with a possible hit, pre-combined
    per task, enter the join, which removes the filter's false positives.
    """
    listed = (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("wide"),
                F.length("path").alias("deep"))
        .groupBy("rule", "wide", "deep").agg(F.max("verdict").alias("verdict"))
    )
    # Paths have at most a few hundred distinct lengths, whatever the number of rules.
    lengths = sorted(r[0] for r in listed.select("deep").distinct().collect())
    bitmap = pages.sparkSession.sparkContext.broadcast(build_filter(listed))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            keys = [candidates(h, p, lengths) for h, p in parts]
            flat = [k for some in keys for k in some]
            hit = iter(holds(bitmap.value, flat).tolist() if flat else ())
            kept = [[k for k in some if next(hit)] for some in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h for h, _ in parts], pa.string()),
                 pa.array([p for _, p in parts], pa.string()),
                 pa.array([k or None for k in kept], pa.list_(pa.string()))],
                ["page_id", "host", "path", "keys"],
            )

    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"))
    probed = urls.mapInArrow(probe, "page_id long, host string, path string, keys array<string>")
    hits = probed.where("keys IS NOT NULL").select("host", "path", F.explode("keys").alias("rule")).distinct()
    decided = (
        hits.join(listed, "rule")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.col("wide") + F.col("deep"), "wide", "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    # Pages of one URL may be most of the rows; set apart, the verdicts let their partition be split.
    return probed.drop("keys").join(apart(decided), ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
