import hashlib
from bisect import bisect_left
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from samples import LONG, MESSY, frame
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sparrowmill.llm import token_alignment
from sparrowmill.llm.packing import printable_bytes
from sparrowmill.llm.token_alignment import align, group_ends, overlaps

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def spelled(texts):
    """(id, bytes) of both sides' tokens by the libraries, or nothing where a side changes the text."""
    tokenizer = Tokenizer.from_file(PATH_A)
    tokenizer.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_file=PATH_B)
    byte = printable_bytes()

    def of_b(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    for text in texts:
        a = b = []
        if text:
            found = tokenizer.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(byte[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
            b = [(i, of_b(i)) for i in pieces.encode(text)]
            whole = (" " + text).encode()
            if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
                a = b = []
        yield a, b


def with_ranges(tokens):
    ends = np.cumsum([len(t) for _, t in tokens]).tolist()
    return [(i, end - len(t), end) for (i, t), end in zip(tokens, ends)]


def plain(texts):
    """Every column by walking over both sides' tokens at once."""
    rows, total = [], Counter()
    for a, b in spelled(texts):
        a, b = with_ranges(a), with_ranges(b)
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i][0], b[j][0]))
            end_a, end_b = a[i][2], b[j][2]
            i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        sides = [[[] for _ in cuts] for _ in (a, b)]
        for side, held in zip((a, b), sides):
            for n, _, end in side:
                held[bisect_left(cuts, end)].append(str(n))
        groups = ["|".join(map(",".join, both)) for both in zip(*sides)]
        total.update(links)
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    highest = Counter()
    for (_, b), n in total.items():
        highest[b] = max(highest[b], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(total[p] == highest[p[1]] for p in links),
         sum(total[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "", g)
        for n_a, n_b, n_groups, links, g in rows
    ]


HARD = [
    "▁a word", "tab\tand\n\nbreaks  and   runs ", " leading", "trailing ", " ", "\n", "<s> </s> <unk> <0x41>",
    "<|endoftext|> it's we'll", "日本語の文 текст עברית", "é ﬁ ½  x y", "\x00 \x1c a\x1fb", "😀👩‍👩‍👧 🏳️‍🌈",
    "a" * 3000, "don't  ▁", "2024-01-01 3.14159 {x: [1, 2]}", "word word word",
]


@pytest.fixture(scope="module")
def whole(documents):
    return align(documents, PATH_A, PATH_B, with_groups=False).toPandas()


def test_equals_a_walk_over_both_sides(texts, whole):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for _, r in whole.iterrows()}
    want = {d: r[:-1] for d, r in zip(texts, plain(list(texts.values())))}
    assert got == want


def test_edge_cases(spark, messy, nothing):
    rows = [*MESSY, *enumerate(HARD, 100)]
    want = Counter(zip([d for d, _ in rows], plain([t for _, t in rows])))
    got = align(frame(spark, rows), PATH_A, PATH_B).collect()
    assert Counter((r["doc_id"], tuple(r[c] for c in (*COLUMNS, "groups"))) for r in got) == want
    for r in got:
        assert len(r["a_ids"]) == 4 * r["n_a"] and len(r["b_ids"]) == 4 * r["n_b"]
    assert align(nothing, PATH_A, PATH_B).collect() == []


def test_rare_pairs_by_join_and_small_blocks(spark, texts, monkeypatch):
    """No pair is broadcast, every text is cut into many blocks, pairs are handed on at once."""
    some = dict(list(texts.items())[:60])
    for name, value in (("FREQUENT", 0), ("BLOCK_TOKENS", 50), ("HELD_PAIRS", 100), ("CACHE_WORDS", 50)):
        monkeypatch.setattr(token_alignment, name, value)
    batch = pa.record_batch({"doc_id": list(some), "text": list(some.values())})
    monkeypatch.setattr(token_alignment.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 3))
    rows = pa.Table.from_batches(token_alignment._aligner(PATH_A, PATH_B, True)(iter([batch]))).to_pandas()
    want = plain(list(some.values()))
    found = rows[rows["row"].notna()]
    assert list(found["groups"]) == [w[-1] for w in want]
    assert list(found["n_links"]) == [w[3] for w in want]
    pairs = rows[rows["pair"].notna()]
    total = pairs.groupby("pair")["count"].sum()
    assert total.sum() == sum(w[3] for w in want) and (total**2).sum() == sum(w[5] for w in want)
    got = align(frame(spark, list(some.items())), PATH_A, PATH_B, with_groups=False).toPandas()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for _, r in got.iterrows()}
    assert got == {d: w[:-1] for d, w in zip(some, want)}


def test_overlaps_and_groups_against_all_pairs():
    rng = np.random.default_rng(3)
    for _ in range(50):
        docs = rng.integers(1, 4)
        sides = []
        for _ in range(2):
            cuts = [np.sort(rng.choice(np.arange(1, 20), rng.integers(0, 6), replace=False)) for _ in range(docs)]
            ends = np.concatenate([np.append(c, 20) + 20 * d for d, c in enumerate(cuts)])
            sides.append((np.repeat(np.arange(docs), [len(c) + 1 for c in cuts]), ends))
        (doc_a, end_a), (doc_b, end_b) = sides
        start_a, start_b = np.append(0, end_a[:-1]), np.append(0, end_b[:-1])
        got = set(zip(*(x.tolist() for x in overlaps(doc_a, start_a, doc_b, start_b))))
        assert got == {
            (i, j) for i in range(len(end_a)) for j in range(len(end_b))
            if start_a[i] < end_b[j] and start_b[j] < end_a[i]
        }
        group_a, group_b = group_ends(end_a, end_b)
        both = sorted(set(end_a) & set(end_b))
        assert [end_a[i - 1] for i in group_a] == both == [end_b[i - 1] for i in group_b]


def test_long_text_has_tokens(spark):
    row = align(frame(spark, [(1, LONG)]), PATH_A, PATH_B, with_groups=False).head()
    assert row["n_a"] > 100_000 and row["n_groups"] > 100_000
    assert row["count_sum"] > row["n_links"]
