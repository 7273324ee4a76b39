import pytest

from lexiforge.llm import url_rules as M
from lexiforge.llm.registry import oracle_sql
from tests.compare import check, connect

CASES = [
    ("https://A.Example.ORG/es/1?x", "a.example.org", "/es/1", "example.org/es/", "block"), ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"), ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"), ("http://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
    ("http://x.com/FR/", "x.com", "/FR/", None, "allow"), ("http://x.net/a", "x.net", "/a", None, "allow"), ("http://example.org?q=/es/", "example.org", "", None, "allow"),
    ("http://org/", "org", "/", "org/", "allow"), ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://a.doubleclick.net/x", "a.doubleclick.net", "/x", None, "block"), ("http://a.net/casino/x", "a.net", "/casino/x", None, "block"), ("http://É.ORG/#/es/", "É.org", "/", "org/", "allow"),
    ("a://b://c", "b:", "//c", None, "allow"), ("http://e.org:80/es/", "e.org:80", "/es/", None, "allow"),
]


@pytest.mark.parametrize("shard", [100_000, 2])
def test_cases(spark, shard):
    pages = spark.createDataFrame([(k, c[0], "h", "r") for k, c in enumerate(CASES)] + [(3, CASES[3][0], "h", "r"), (None, "http://x.org/", None, "r")], "page_id long, url string, host string, rule string")
    got = M.judge(pages.repartition(2), shard=shard).collect()
    assert len(got) == len(CASES) + 2
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == CASES[r.page_id][1:], CASES[r.page_id]


def test_equals_all_rules_on_all_urls(spark):
    import random
    import re

    rng = random.Random(6)
    hosts = ["a.org", "b.a.org", "com", "x.com", "aorg"]
    rules = tuple((rng.choice(hosts), rng.choice(["/", "/a", "/a/", "/a/b", "/b/1"]), rng.choice(["allow", "block"])) for _ in range(30))
    urls = [f"http://{rng.choice(['', 'w.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/a/b/c', '/b/12', '/ab'])}" for _ in range(300)]
    got = M.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules, ()).collect()
    for r in got:
        host, path = M.split_url(urls[r.page_id])
        fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if re.search(rf"(^|\.){re.escape(h)}$", host) and path.startswith(p)]
        assert (r.rule, r.verdict) == (max(fits)[2:] if fits else (None, "allow"))


def test_ties_and_many_rules(spark):
    rules = (("x.com", "/ab", "block"), ("com", "/abcd", "block"), *((f"h{k}.net", "/", "block") for k in range(3000)))
    pages = spark.createDataFrame([(1, "http://x.com/abcd"), (2, "http://w.h7.net/"), (3, "http://h3000.net/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in M.judge(pages, rules, ()).collect()}
    assert got == {1: ("x.com/ab", "block"), 2: ("h7.net/", "block"), 3: (None, "allow")}


def test_empty(spark, sf_dir):
    assert M.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert M.judge(spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string"), (), ()).first().verdict == "allow"
    check(M.op2_url_rules(spark, sf_dir), connect(sf_dir), oracle_sql()["op2_url_rules"])
