import hashlib
from collections import defaultdict

import numpy as np
from samples import MESSY, frame

from sparrowmill.llm.line_dedup import (
    bit_positions, dedup_lines, merge_filters, repeated_lines, without_shared_lines,
)


def key_of(line):
    stripped = line.strip(" \t\n\r\x0b\x0c")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)


def brute(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                if len(key_of(line)) >= min_chars:
                    holders[key_of(line)].add(doc_id)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or keeper.get(key_of(x), doc_id) == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(df, *args):
    return sorted((tuple(r) for r in dedup_lines(df, *args).collect()), key=repr)


def test_edge_cases(messy, nothing):
    assert run(messy, 4, 2) == brute(MESSY, 4, 2)
    assert run(nothing) == []
    assert without_shared_lines(messy).columns == messy.columns
    assert without_shared_lines(messy).count() == len(MESSY)


def test_hot_lines_against_brute_force(spark):
    shared = "A passage that many documents share, word for word"
    rows = [(i, f"own line of document number {i}\n{shared}\n{'x' * (i % 7)}\n {shared.upper()}\t") for i in range(300)]
    rows += [(1000 + i, "é" * 39 + ("é" if i % 2 else "")) for i in range(20)]
    assert run(frame(spark, rows), 40, 5) == brute(rows, 40, 5)


def test_null_text_stays_null(spark):
    df = frame(spark, [(1, None), (2, "x")])
    assert dict(without_shared_lines(df).select("doc_id", "text").collect()) == {1: None, 2: "x"}


def test_filters_merge_in_any_order_and_miss_no_repeat():
    import zlib

    rng, bits = np.random.default_rng(5), 1 << 12
    keys = [hashlib.sha256(bytes([i])).digest() for i in range(60)]
    parts = []
    for _ in range(5):
        chosen = rng.choice(60, 20, replace=False)
        once = np.zeros(bits // 8, np.uint8)
        at = bit_positions([keys[i] for i in chosen], bits).ravel()
        np.bitwise_or.at(once, at >> 3, (1 << (at & 7)).astype(np.uint8))
        parts.append((set(chosen.tolist()), zlib.compress(np.stack([once, 0 * once]).tobytes())))
    left = parts[0][1]
    for _, p in parts[1:]:
        left = merge_filters(left, p)
    right = parts[4][1]
    for _, p in parts[3::-1]:
        right = merge_filters(p, right)
    assert zlib.decompress(left) == zlib.decompress(right)
    twice = np.frombuffer(zlib.decompress(left), np.uint8)[bits // 8 :]
    repeated = [i for i in range(60) if sum(i in s for s, _ in parts) > 1]
    at = bit_positions([keys[i] for i in repeated], bits)
    assert ((twice[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all()


def test_only_repeats_are_confirmed(documents):
    drops = repeated_lines(documents)
    assert 0 < drops.count() < documents.count()
