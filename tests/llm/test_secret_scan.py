import random
import re
from dataclasses import replace

import pytest
from samples import MESSY, frame

from sparrowmill.llm.queries import QUERIES
from sparrowmill.llm.secret_scan import RULES, Rule, address, scan_secrets

# As the rules are stated, before they are put in a form for engines.
PLAIN = (
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"""((?-i:[A-Za-z0-9+/_.=-]+))"""), 2, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
)


def plain(text):
    spans = [
        (m.start(), place, kind, m.end())
        for place, (kind, pattern, group, least) in enumerate(PLAIN)
        for m in pattern.finditer(text or "") if len(m[group]) >= least
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def spans(row):
    return [tuple(s) for s in row["spans"]]


HARD = [
    'secret: token="abcdefghijk"', "token==abcdefg token = = abcdefghi", "PassWord:'Zz9+/_.=-' x", "toKen=12345678",
    "ſecret=12345678", "api_key=api_key=12345678", "apikey  =  \"12345678", "password\n=12345678",
    "AKIA" + "A" * 11 + " AKIA" + "B" * 12 + "AKIA" * 5, "xAKIAAKIA0123456789", "😀 " + "0f" * 16 + "é" + "ab" * 15,
    "token=" + "a1" * 20 + "," + "0" * 33, "f" * 100_000, "token=12345678 " * 3000, "deadbeef" * 4 + "G" + "deadbeef" * 4,
]


def test_equals_plain_search(spark, messy, nothing):
    rows = [*MESSY, *enumerate(HARD, 100)]
    rng = random.Random(5)
    bits = ["token", "API_KEY", "secret", '"', "'", " ", "  ", "=", ":", "abcd", "12345678", "AKIA", "ABCDEFGH", "0f0f0f0f", "é", "\n"]
    rows += [(1000 + i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 30)))) for i in range(300)]
    got = scan_secrets(frame(spark, rows)).collect()
    assert sorted(map(repr, ((r["doc_id"], spans(r)) for r in got))) == sorted(map(repr, ((d, plain(t)) for d, t in rows)))
    assert scan_secrets(nothing).collect() == []


def test_whole_table(documents, texts):
    got = {r["doc_id"]: spans(r) for r in scan_secrets(documents).collect()}
    assert got == {d: plain(t) for d, t in texts.items()}
    assert any(got.values())


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = frame(spark, [(1, "token=abcdefgh"), (2, "token=abcdefgh"), (3, None)])
    second = frame(spark, [(1, "token=abcdefgh"), (4, "f" * 40), (5, "")])
    kinds = lambda rows: {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in rows}
    scanned = lambda: spark.read.parquet(f"{ledger}/scanned")

    assert kinds(scan_secrets(first, ledger=ledger).collect()) == {1: ["assign"], 2: ["assign"], 3: []}
    assert scanned().count() == 2  # the text once, and the empty one
    assert kinds(scan_secrets(second, ledger=ledger).collect()) == {1: ["assign"], 4: ["hex"], 5: []}
    assert scanned().count() == 3
    before = scanned().count()
    scan_secrets(second, ledger=ledger).collect()
    assert scanned().count() == before  # nothing is scanned twice

    newer = (replace(RULES[0], version=2, least=9), *RULES[1:], Rule("mail", 1, "[a-z]+@[a-z]+"))
    assert kinds(scan_secrets(first, newer, ledger).collect()) == {1: [], 2: [], 3: []}
    again = [sorted(r["rules"]) for r in scanned().collect()]
    assert again.count(["assign@2", "mail@1"]) == 2  # only the new pairs
    # The old version's findings are still there for who asks for them.
    assert kinds(scan_secrets(first, ledger=ledger).collect()) == {1: ["assign"], 2: ["assign"], 3: []}


def test_failed_update_is_done_again(spark, tmp_path):
    """Findings without their entry in ``scanned`` are found again and counted once."""
    ledger, rows = str(tmp_path / "ledger"), frame(spark, [(1, "f" * 40)])
    scan_secrets(rows, ledger=ledger).collect()
    spark.read.parquet(f"{ledger}/findings").write.parquet(f"{tmp_path}/other/findings")
    (row,) = scan_secrets(rows, ledger=f"{tmp_path}/other").collect()
    assert spans(row) == [("hex", 0, 40)]
    assert spark.read.parquet(f"{tmp_path}/other/findings").count() == 2


def test_paths_keep_their_own_columns(spark):
    rows = spark.createDataFrame([("a", 1, "token=abcdefgh", 7), ("a", 2, "x", 8)], "path string, `row` int, text string, rules int")
    got = scan_secrets(rows, keep=("path", "row", "rules")).orderBy("row")
    assert [tuple(r)[:3] for r in got.collect()] == [("a", 1, 7), ("a", 2, 8)]
    assert got.columns == ["path", "row", "rules", "blob", "spans"]
    want = rows.select(address(rows["text"]).alias("blob")).collect()
    assert {bytes(r["blob"]) for r in got.collect()} == {bytes(r["blob"]) for r in want}
    with pytest.raises(ValueError):
        scan_secrets(rows.withColumnRenamed("path", "blob"), keep=("blob",))


def test_plan_is_native(spark, tiny):
    plan = QUERIES["op13_secret_scan"](spark, tiny)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|RDDScan", plan)
