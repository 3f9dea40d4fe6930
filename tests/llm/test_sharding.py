import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from samples import MESSY

from sparrowmill.llm.sharding import hilbert_index, shard, write_shards


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_in_steps_of_one(dims, bits):
    cells = np.indices((1 << bits,) * dims).reshape(dims, -1)
    index = hilbert_index(list(cells), bits)
    assert sorted(index.tolist()) == list(range(cells.shape[1]))
    path = cells[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def check(rows, total, shards):
    by = Counter(r["shard"] for r in rows)
    assert len(rows) == total and set(by) <= set(range(shards))
    for s in by:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(by[s]))
    return by


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_laws(documents, texts, law):
    rows = shard(documents, 40, law).collect()
    by = check(rows, len(texts), 40)
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), law)
    if law == "rows":
        assert len(by) == 40 and max(by.values()) - min(by.values()) <= 1
    else:
        sizes = Counter()
        for r in rows:
            sizes[r["shard"]] += r["size"]
        largest = max(r["size"] for r in rows)
        mean = sum(sizes.values()) / 40
        assert all(abs(sizes[s] - mean) <= largest for s in range(40))


def test_equal_texts_stay_together(documents, texts):
    rows = shard(documents, 10, "rows").collect()
    where = {}
    for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])):
        where.setdefault(texts[r["doc_id"]], []).append((r["shard"], r["slot"]))
    parted = [p for p in where.values() if len({s for s, _ in p}) > 1]
    assert len(parted) <= 9  # only where a run ends
    for places in where.values():
        if len({s for s, _ in places}) == 1:
            slots = [slot for _, slot in places]
            assert slots == list(range(slots[0], slots[0] + len(slots)))


def test_shards_cover_small_boxes(documents):
    """A shard's range of a dimension is narrower than under no order."""
    rows = shard(documents, 10, "rows", ["n_chars", "doc_id"]).join(documents.select("doc_id", "n_chars"), "doc_id")
    ranges = rows.toPandas().groupby("shard")["doc_id"].agg(lambda x: x.max() - x.min())
    assert ranges.mean() < 0.75 * documents.count()


def test_edge_cases(messy, nothing):
    for law in ("rows", "bytes"):
        check(shard(messy, 4, law).collect(), len(MESSY), 4)
        assert shard(nothing, 4, law).collect() == []
        check(shard(messy, 40, law).collect(), len(MESSY), 40)


def test_written_shards(spark, documents, tmp_path):
    some = documents.where("doc_id < 100")
    write_shards(some, shard(some, 5), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
    assert len(list((tmp_path / "out").glob("shard=*"))) == 5


def test_text_with_a_common_beginning_is_told_apart(spark):
    rows = [(i, f"text {i}", f"https://example.org/{i * 7919 % 64:02d}" if i % 65 else None) for i in range(6500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed = shard(df, 32, "rows", ["source"]).join(df.select("doc_id", "source"), "doc_id").collect()
    by = {}
    for r in placed:
        by.setdefault(r["source"], set()).add(r["cell"])
    assert all(len(c) == 1 for c in by.values())
    order = [min(by[s]) for s in sorted(by, key=lambda s: s or "")]
    assert order == sorted(order) and len(set(order)) == 32  # the curve of one dimension is its order
    held = {}
    for r in placed:
        held.setdefault(r["shard"], set()).add(r["source"])
    assert max(len(s) for s in held.values()) <= 5


def walked(dims, bits):
    """Every cell's place on the curve, by walking along it: each place's Gray code is split over the axes,
    and the turns of the sub-cubes are done again from the lowest plane up."""
    places = {}
    for index in range(1 << dims * bits):
        x = [0] * dims
        for bit in range(dims * bits):
            x[dims - 1 - bit % dims] |= (index >> bit & 1) << bit // dims
        top = x[-1] >> 1
        for i in range(dims - 1, 0, -1):
            x[i] ^= x[i - 1]
        x[0] ^= top
        for plane in range(1, bits):
            low = (1 << plane) - 1
            for i in range(dims - 1, -1, -1):
                if x[i] >> plane & 1:
                    x[0] ^= low
                else:
                    swap = (x[0] ^ x[i]) & low
                    x[0], x[i] = x[0] ^ swap, x[i] ^ swap
        places[tuple(x)] = index
    return places


def cells_of(values, cells):
    """Numbers by the quantiles of all values; texts by the middle of their rows in the order of all."""
    n = len(values)
    if isinstance(values[0], str):
        seen, out = 0, {}
        for value, rows in sorted(Counter(values).items(), key=lambda v: v[0].encode()):
            out[value] = min(math.floor((seen + rows / 2) * cells / n), cells - 1)
            seen += rows
        ranks = sorted(set(out.values()))
        return [ranks.index(out[v]) for v in values]
    held = sorted(values)
    edges = sorted({held[max(math.ceil(i / cells * n), 1) - 1] for i in range(1, cells)})
    return [sum(e <= v for e in edges) for v in values]


def test_order_equals_a_walk_along_the_curve(documents):
    bits, shards = 2, 40
    rows = documents.select("doc_id", "text", "lang", "source", "n_chars").collect()
    columns = [cells_of([r[c] for r in rows], 1 << bits) for c in ("lang", "source", "n_chars", "doc_id")]
    place, lead = walked(4, bits), {}
    for r, cell in sorted(zip(rows, zip(*columns)), key=lambda p: p[0]["doc_id"]):
        lead.setdefault(r["text"], place[cell])
    same = lambda r: hashlib.md5((r["text"] or "").encode()).hexdigest()
    ordered = sorted(rows, key=lambda r: (lead[r["text"]], same(r), r["doc_id"]))
    want, first = {}, {}
    for at, r in enumerate(ordered):
        number = at * shards // len(rows)
        first.setdefault(number, at)
        want[r["doc_id"]] = (number, at - first[number], lead[r["text"]])
    got = {r["doc_id"]: (r["shard"], r["slot"], r["cell"]) for r in shard(documents, shards, "rows", bits=bits).collect()}
    assert got == want
