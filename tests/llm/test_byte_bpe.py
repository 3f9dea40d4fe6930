import random
import sys

import numpy as np
import public_tokenizers
import pytest

import regex
import tiktoken
from samples import MESSY

from sparrowmill.llm import byte_bpe
from sparrowmill.llm.byte_bpe import Words, decode, encode, encode_texts, merge_long, merge_words, read_ranks
from sparrowmill.llm.pretokens import BLOCK, byte_slices

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def words():
    return Words(read_ranks(PATH))


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def sample(count, seed):
    parts = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\r\n", "\t", "a", "é", "1", "²", "!", "…",
             "　", "\x85", "​", "中", "😀", "\x00", "'s", "\x1c", "᠎", "<|endoftext|>"]
    rng = random.Random(seed)
    return ["".join(rng.choices(parts, k=rng.randrange(0, 3 * BLOCK))) for _ in range(count)]


def test_boundaries_are_those_of_the_pattern():
    texts = sample(400, 1)
    data, starts, before = byte_slices(texts)
    cuts = [*starts.tolist(), len(data)]
    found = [data[a:b].decode() for a, b in zip(cuts, cuts[1:])]
    got = [found[a:b] for a, b in zip(before.tolist(), before[1:].tolist())]
    assert got == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]


def test_ids_are_the_librarys(library, words, texts):
    several = [*sample(300, 2), *list(texts.values())[:300], "", "a" * 3000, "'" * 300, " " * 5000]
    assert [ids(p) for p in encode_texts(several, words)] == [library.encode_ordinary(t) for t in several]


def test_every_code_point(library, words):
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    rows = ["".join(f"a{c}1{c}!{c} {c}" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    for i in range(0, len(rows), 100):
        some = rows[i : i + 100]
        assert [ids(p) for p in encode_texts(some, words)] == [library.encode_ordinary(t) for t in some]


def test_both_merge_orders_agree(words):
    rng = random.Random(3)
    some = [bytes(rng.choices(b"abcdethin ", k=rng.randrange(2, 49))) for _ in range(300)]
    assert [ids(p) for p in merge_words(some, words.pairs)] == [merge_long(w, words.ranks) for w in some]


def test_edge_cases_and_round_trip(messy, nothing, library):
    rows = decode(encode(messy, PATH), PATH).collect()
    got = sorted(((r["doc_id"], ids(r["ids"]), bytes(r["decoded"])) for r in rows), key=repr)
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in MESSY]
    assert got == sorted(want, key=repr)
    assert decode(encode(nothing, PATH), PATH).collect() == []


def test_one_pass_gives_the_same(messy):
    one, two = byte_bpe.round_trip(messy, PATH), decode(encode(messy, PATH), PATH)
    assert one.dtypes == two.dtypes and sorted(one.collect(), key=repr) == sorted(two.collect(), key=repr)


def test_offsets_are_where_tokens_start(messy, library):
    for r in encode(messy.where("doc_id = 8"), PATH).collect():
        sizes = [len(library.decode_single_token_bytes(i)) for i in ids(r["ids"])]
        assert ids(r["offsets"]) == np.cumsum([0, *sizes])[:-1].tolist()
        assert r["n_bytes"] == sum(sizes)
