import hashlib

import numpy as np
import pytest
from samples import MESSY, frame

from sparrowmill.llm import fingerprints
from sparrowmill.llm.fingerprints import Parse, compare_edited, fingerprint, likeness


def phrases(data):
    """The phrases of a plain LZ78 parse."""
    known, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in known:
            known.add(data[start:end])
            start = end
    return known


def test_phrases_are_those_of_a_plain_parse(texts):
    for text in [*list(texts.values())[:50], "", "aaaaaaa", "ab" * 100]:
        parse = Parse()
        parse.feed(text.encode())
        assert len(set(parse.hashes[1:])) == len(phrases(text.encode())) == len(parse.keys)


def test_a_parse_can_be_taken_back():
    parse, plain = Parse(), Parse()
    parse.feed(b"abababcabc")
    mark = parse.mark()
    parse.feed(b"xyzxyz")
    parse.back(mark)
    parse.feed(b"abcd")
    plain.feed(b"abababcabcabcd")
    assert (parse.phrases, parse.hashes, parse.at) == (plain.phrases, plain.hashes, plain.at)


def test_likeness_estimates_the_share_of_common_phrases(texts):
    some = [t for t in texts.values() if len(t) > 2000][:40]
    errors = []
    for a, b in zip(some, some[1:]):
        mixed = a[: len(a) // 2] + b
        p, q = phrases(a.encode()), phrases(mixed.encode())
        errors.append(likeness(fingerprint(a), fingerprint(mixed)) - len(p & q) / len(p | q))
    assert np.abs(errors).max() < 0.2 and abs(np.mean(errors)) < 0.03


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text)
        edited = text[: n - n // 3] + following[: n // 3]
        a, b, c = fingerprint(text), fingerprint(edited), fingerprint(following)
        out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(),
                    likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_bytes", [1 << 24, 1 << 16])
def test_whole_table(documents, texts, monkeypatch, part_bytes):
    monkeypatch.setattr(fingerprints, "PART_BYTES", part_bytes)
    got = sorted((tuple(r) for r in compare_edited(documents).collect()), key=repr)
    assert got == brute(list(texts.items()))
    near, following = np.mean([r[5] for r in got]), np.mean([r[6] for r in got])
    assert near > 0.5 > following


@pytest.mark.parametrize("part_bytes", [1 << 24, 50])
def test_edge_cases(spark, messy, nothing, monkeypatch, part_bytes):
    monkeypatch.setattr(fingerprints, "PART_BYTES", part_bytes)
    assert sorted((tuple(r) for r in compare_edited(messy).collect()), key=repr) == brute(MESSY)
    assert compare_edited(nothing).collect() == []
    one = compare_edited(frame(spark, [(3, "abcdef")])).collect()
    assert [tuple(r) for r in one] == brute([(3, "abcdef")])


def test_very_long_texts_are_not_alike_by_chance():
    """As many phrases as about 17 MB of text have."""
    rng = np.random.default_rng(5)
    signatures = []
    for _ in range(3):
        parse = Parse()
        parse.hashes += rng.integers(0, 1 << 64, 2_000_000, dtype=np.uint64).tolist()
        signatures.append(parse.signature())
        assert (signatures[-1] != fingerprints.EMPTY).all()
    pairs = [(0, 1), (0, 2), (1, 2)]
    assert np.mean([likeness(signatures[i], signatures[j]) for i, j in pairs]) < 0.01


def test_slots_without_a_phrase_are_empty():
    parse = Parse()
    parse.feed(b"abcabc")
    assert (parse.signature() != fingerprints.EMPTY).sum() == len({*parse.signature().tolist()} - {fingerprints.EMPTY})
    assert (Parse().signature() == fingerprints.EMPTY).all()
