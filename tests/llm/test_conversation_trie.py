import hashlib
import random
import re
import zlib

import pytest

from sparrowmill.llm.conversation_trie import numbered_turns, prefix_trie, with_borrowed_starts

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    """conv_id to its turns, the first h of them lent by another conversation."""
    whole = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            whole.setdefault(c, []).append(((turn is not None, turn or 0, digest[:16]), (role, text)))
    whole = {c: [t for _, t in sorted(turns, key=lambda t: t[0])] for c, turns in whole.items()}
    out = {}
    for c, turns in whole.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = whole.get(base, [])[:h] + turns[h:]
    return out


def plain(conversations):
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(members) - 1) * words
    rows = []
    for path, members in nodes.items():
        ends = sorted(c for c in members if len(conversations[c]) == len(path))
        rows.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), children.get(path, 0),
            leaves[path], saved[path], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def table_of(spark, rows):
    schema = "conv_id long, turn long, role string, text string, place long, `key` int, h string, `block x` int"
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], schema)


def random_rows(seed, conversations, most, ids):
    rng = random.Random(seed)
    texts = ["hi", "hi there", "", None, "a\tb\x0bc", "two\nlines of it"]
    return [
        (c, turn, rng.choice(["user", "assistant", None]), rng.choice(texts[: rng.randint(1, 6)]))
        for c in ids(conversations) for turn in range(rng.randint(1, most))
    ]


def trie(spark, rows, **sizes):
    return prefix_trie(with_borrowed_starts(numbered_turns(table_of(spark, rows))), **sizes)


def test_equals_plain_trie(spark):
    rows = random_rows(1, 150, 6, lambda n: range(-n // 3, n))
    rows += [(7, None, "user", "hi"), (7, None, "user", "again"), (8, 0, "user", "tie"), (8, 0, "user", "tie")]
    rows += [(None, 0, "user", "hi"), (10**15, 0, "user", "a far base"), (-(2**63), 0, None, None)]
    random.Random(2).shuffle(rows)
    assert got(trie(spark, rows)) == plain(rebuilt(rows))


def test_small_shards_and_blocks(spark):
    """Nodes of one key from many shards, and conversations over many blocks."""
    rows = random_rows(3, 60, 12, range)
    start = [(turn, "user", "same start") for turn in range(30)]
    rows += [(1000 + i, *t) for i in range(8) for t in start]
    rows += [(1000 + i, 30 + j, "user", "tail") for i in range(5) for j in range(i)]
    want = plain(rebuilt(rows))
    assert got(trie(spark, rows, block=4, most=3, most_turns=20)) == want
    assert got(trie(spark, rows, block=2)) == want


def test_a_hot_conversation_and_hot_copies(spark):
    rows = [(5, i, "user", "w" * (i % 3)) for i in range(9000)]
    rows += [(100 + i, 0, "user", "one turn") for i in range(500)]
    whole = rebuilt(rows)
    nodes = got(trie(spark, rows, block=512))
    assert sum(n[1] == 0 for n in nodes) == 1 and max(n[1] for n in nodes) == max(map(len, whole.values()))
    root = next(n for n in nodes if n[1] == 0)
    assert root[3] == len(whole) and root[5] == sum(n[4] == 0 for n in nodes)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversation_gives_no_row(spark, rows):
    assert trie(spark, rows).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    """Ids whose own turns all go and whose lender does not exist."""
    ids = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "gone") for c in ids]
    (row,) = got(trie(spark, rows))
    assert row == (ids[0], 0, None, len(ids), 0, 1, 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
