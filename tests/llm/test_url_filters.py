import random

from sparrowmill.llm.queries import URL_RULES
from sparrowmill.llm.url_filters import build_filter, candidates, holds, judge, split_url

URLS = [
    None, "", "no mark", "://", "http://", "http://NET/", "http://net", "http://a.net/x", "http://anet/",
    "HTTP://WWW.Example.NET/en/1?x#y", "http://example.net/EN/", "http://example.net/en", "http://example.com/de/",
    "http://example.com?/de/", "http://sub.sub.example.com/de/x", "http://org/fr/", "http://x.org/fr/#a",
    "http://x.org#/fr/", "ftp://u@h.net:80/p", "http://a..net/", "http://ÄÖ.net/", "http://.net/", "x://y://net/",
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1].split("#", 1)[0].split("?", 1)[0]
        host, slash, tail = rest.partition("/")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = slash + tail
    fits = [
        (len(h) + len(p), len(h), h + p, v) for v, h, p in rules
        if path.startswith(p) and (host == h or host.endswith("." + h))
    ]
    _, _, rule, verdict = max(fits, default=(0, 0, None, default))
    return host, path, rule, verdict


def run(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "html", "h", "v") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string, verdict string")
    listed = spark.createDataFrame(rules, "verdict string, host string, path string")
    return {r["page_id"]: tuple(r)[1:] for r in judge(pages, listed).collect()}


def test_published_rules(spark):
    assert run(spark, URLS, list(URL_RULES)) == {i: brute(u, URL_RULES) for i, u in enumerate(URLS)}


def test_random_rules(spark):
    rng = random.Random(5)
    label = lambda: rng.choice("ab")
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 4)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randrange(0, 4)))
    rules = sorted({(host(), path()): rng.choice(["block", "allow"]) for _ in range(40)}.items())
    rules = [(v, h, p) for (h, p), v in rules]
    urls = [f"http://{host()}{path()}" for _ in range(400)] * 2
    assert run(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_pages_no_rules_and_null_rules(spark):
    assert run(spark, [], list(URL_RULES)) == {}
    assert run(spark, URLS, []) == {i: brute(u, []) for i, u in enumerate(URLS)}
    assert run(spark, URLS, [("block", None, "/"), (None, "net", "/")]) == {
        i: brute(u, []) for i, u in enumerate(URLS)
    }


def test_the_filter_misses_nothing_and_passes_little(spark):
    rules = spark.createDataFrame([(f"host{i}.net/",) for i in range(2000)], "rule string")
    bitmap = build_filter(rules)
    assert holds(bitmap, [f"host{i}.net/" for i in range(2000)]).all()
    assert holds(bitmap, [f"other{i}.org/" for i in range(5000)]).mean() < 0.02


def test_candidates_are_parents_times_beginnings():
    assert split_url("http://A.b.C/x/y?z") == ("a.b.c", "/x/y")
    assert candidates("a.b", "/x", [0, 1, 5]) == ["a.b", "a.b/", "b", "b/"]
