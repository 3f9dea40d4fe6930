import re

from samples import MESSY, frame

from sparrowmill.llm.license_scan import NOTICES, notices, scan_licenses

LONG_NOTICE = dict(NOTICES)["MIT-permission"]


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(found, n=5):
    return [" ".join(found[i : i + n]) for i in range(len(found) - n + 1)]


def brute(rows, templates):
    out = set()
    for doc_id, text in rows:
        for name, template in templates:
            n = min(5, len(words(template)))  # a template of less than five words is one shingle
            if not n:
                continue
            have, want = shingles(words(text), n), shingles(words(template), n)
            share = max((len(set(want) & set(have[s : s + len(want)])) / len(set(want))
                         for s in range(len(have))), default=0)
            if share >= 0.8:
                out.add((doc_id, name, share))
    return out


def run(spark, df, templates=NOTICES):
    listed = spark.createDataFrame(list(templates), "license string, text string")
    return {(r["doc_id"], r["license"], r["containment"]) for r in scan_licenses(df, listed).collect()}


def changed(text, *places):
    found = text.split()
    for p in places:
        found[p] = "changed"
    return " ".join(found)


def test_exact_near_and_far_copies(spark):
    rows = [(i, f"Before it. {text} after it") for i, (_, text) in enumerate(NOTICES)]
    rows += [(100, LONG_NOTICE.upper().replace(" ", "\n  ")), (101, changed(LONG_NOTICE, 3)),
             (102, changed(LONG_NOTICE, 3, 40)), (103, changed(LONG_NOTICE, 5, 20, 35, 50)),
             (104, "x " * 500 + LONG_NOTICE + " y" * 500), (105, LONG_NOTICE[:150]),
             (106, f"{NOTICES[0][1]} {NOTICES[3][1]} " * 30)]
    found = run(spark, frame(spark, rows))
    assert found == brute(rows, NOTICES)
    assert {name for i, name, _ in found if i < 100} == {name for name, _ in NOTICES}
    assert not [r for r in found if r[0] in (103, 105)]


def test_where_it_stands(spark):
    df = frame(spark, [(1, "one two three " + NOTICES[3][1] + " tail")])
    assert [r["word_at"] for r in scan_licenses(df, notices(spark)).collect()] == [3]


def test_edge_cases(spark, messy, nothing):
    templates = [("own", "equal TEXT of a few words"), ("short", "too short"), ("none", None)]
    assert run(spark, messy, templates) == brute(MESSY, templates)
    assert scan_licenses(messy, spark.createDataFrame(templates[:1], "license string, text string")).count() == 4
    assert run(spark, nothing) == set()
    assert run(spark, messy, templates[1:]) == set()


def test_plan_is_native(spark, documents):
    plan = scan_licenses(documents, notices(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_short_templates_are_found_word_for_word(spark, messy):
    templates = [("arr", "All rights reserved."), ("one", "Copyleft"), ("four", "no rights reserved here"),
                 ("arr", "ALL rights  reserved"), ("two", "rights reserved"), ("none", "..."),
                 ("long", "equal TEXT of a few words")]
    listed = spark.createDataFrame(templates, "license string, text string")
    df = frame(spark, [(1, "x (c) ALL RIGHTS\nreserved, all rights reserved"), (2, "all rights are reserved"),
                       (3, "all rights"), (4, "copyleft; no rights reserved here"), (5, "all rights all rights reserved"),
                       (6, None), (None, "Copyleft"), (7, "Equal text of a few words")])
    got = sorted((tuple(r) for r in scan_licenses(df, listed).collect()), key=repr)
    want = [(1, "arr", 1.0, 2), (1, "two", 1.0, 3), (4, "four", 1.0, 1), (4, "one", 1.0, 0), (4, "two", 1.0, 2),
            (5, "arr", 1.0, 2), (5, "two", 1.0, 3), (7, "long", 1.0, 0), (None, "one", 1.0, 0)]
    assert got == sorted(want, key=repr)
    plan = scan_licenses(df, listed)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_the_planted_short_notice_is_listed(spark, documents, texts):
    have = {i for i, t in texts.items() if "all rights reserved" in " ".join(words(t))}
    found = scan_licenses(documents, notices(spark)).where("license = 'All-rights-reserved'").collect()
    assert have and {r["doc_id"] for r in found} == have
