import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from samples import MESSY
from tokenizers import Tokenizer

from sparrowmill.llm.packing import Bins, blocks, cut_document, encoder, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_ids_are_the_tokenizer_files(texts):
    several = [*list(texts.values())[:200], *[t for _, t in MESSY if t and len(t) < 1000]]
    ids = encoder(PATH)
    got = [ids.encode_ordinary(t) for t in several]
    assert got == [e.ids for e in library().encode_batch(several, add_special_tokens=False)]


def test_only_longer_documents_are_cut():
    for length in (1, 5, 8, 9, 16, 17, 100):
        pieces = cut_document(length, 8)
        assert sum(n for _, n in pieces) == length
        assert [at for at, _ in pieces] == np.cumsum([0, *[n for _, n in pieces]])[:-1].tolist()
        assert all(n == 8 for _, n in pieces[1:]) and pieces[0][1] <= 8
        assert len(pieces) == 1 or length > 8


def test_bins_are_best_fit_and_the_fullest_closes_first():
    rng, size, most = random.Random(4), 50, 6
    bins, open_, made = Bins(size, most), [], 0
    for _ in range(3000):
        length = rng.randint(1, size)
        number, offset = bins.put(length)
        fitting = [free for _, free in open_ if free >= length]
        if fitting:
            free = min(fitting)
            assert size - offset == free and (number, free) in open_
            open_.remove((number, free))
        else:
            assert (number, offset) == (made, 0)
            free, made = size, made + 1
        if free > length:
            open_.append((number, free - length))
        if len(open_) > most:
            least = min(free for _, free in open_)
            gone = [b for b in open_ if b[1] == least and b[0] not in bins.free[least]]
            assert len(gone) == 1
            open_.remove(gone[0])


def test_blocks_keep_every_row():
    batches = [pa.record_batch({"x": list(range(a, b))}) for a, b in ((0, 3), (3, 3), (3, 20), (20, 21))]
    found = [b.column("x").to_pylist() for b in blocks(iter(batches), 5)]
    assert [len(f) for f in found] == [5, 5, 5, 5, 1] and sum(found, []) == list(range(21))


def check(rows, docs, size):
    encode = library()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    want = []
    for doc_id, text in docs:
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, (start, length) in enumerate(cut_document(len(ids), size)):
            part = np.array(ids[start : start + length], "<u4").tobytes()
            want.append((doc_id, piece, start, length, zlib.crc32(part)))
    got = [tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return len(by_sequence), -(-sum(n for *_, n, _ in want) // size)


def test_packs_every_document(documents, texts):
    made, least = check(pack(documents, PATH, 2048, with_ids=False).collect(), texts.items(), 2048)
    assert made <= 1.01 * least


def test_edge_cases(messy, nothing):
    rows = pack(messy, PATH, 512).collect()
    check(rows, MESSY, 512)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    assert pack(nothing, PATH).collect() == []


def test_ids_stay_out_of_the_packing_tasks(documents):
    plan = pack(documents, public_tokenizers.path("byte_bpe_50k.json"))._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("Repartition") :].splitlines()[1]
    assert "length#" in dealt and "ids#" not in dealt


def test_rows_that_repeat_keep_their_own_ids(spark):
    rows = [(1, "one two three"), (1, "one two three"), (1, "four"), (None, "five"), (None, None)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=16).collect()
    assert len(packed) == len(rows)
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in packed)
    used = {}
    for r in packed:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 16
