import itertools
import re

import pytest

from ridemart.llm import url_filter

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (found[1].translate(UPPER), found[2]) if found else ("", "")


def expected(url, rules):
    host, path = parts(url)
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, url_filter.ALLOW))
    return host, path, best[2], best[3]


URLS = [
    None,
    "",
    "no scheme/at all",
    "http://",
    "http://example.org",
    "http://Example.ORG/es/1",
    "https://a.b.example.org/en/1234?x=http://com/de/",
    "https://notexample.org/es/",
    "https://x.com/fr/1#frag",
    "https://x.com/FR/1",
    "ftp://x.com/de/",
    "http://x.com:80/de/",
    "a://b://c.org/",
    "http://org/",
    "http://.org/x",
    "http://é.org/ü/\nnew",
    "http://" + ".".join("a" * 1 for _ in range(300)) + ".org/" + "p" * 100_000,
]


@pytest.fixture
def pages(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, "http://x.org/"), (3, "http://x.org/")][:0]
    rows += [(None, "http://x.org/", None), (3, "http://x.org/", "h"), (3, "http://x.org/", "h")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def judged(pages, rules, spark):
    out = url_filter.judge(pages, url_filter.rule_table(spark, rules))
    return sorted(((r.url or "", r.url is None, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=repr)


def wanted(rules):
    urls = [*URLS, *["http://x.org/"] * 3]
    return sorted(((u or "", u is None, *expected(u, rules)) for u in urls), key=repr)


@pytest.mark.parametrize("most", [10**6, 0])
def test_matches_brute_force(spark, pages, monkeypatch, most):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", most)
    assert judged(pages, url_filter.RULES, spark) == wanted(url_filter.RULES)


def test_precedence_and_ties(spark, pages):
    rules = [("org", "/", "block"), ("org", "/", "allow"), ("b.example.org", "/en", "allow"), ("example.org", "/en/12", "block"),
             ("com", "", "block"), ("", "/", "block")]
    assert judged(pages, rules, spark) == wanted(rules[:1] + rules[2:])


def test_every_shape_of_rule(spark):
    hosts = [".".join(h) for n in (1, 2, 3) for h in itertools.product("ab", repeat=n)]
    rules = [(h, p, v) for h, p, v in itertools.product(hosts[::2], ["", "/", "/a"], ["allow"])] + [(hosts[1], "/ab", "block")]
    urls = [f"x://{h}{p}" for h in hosts for p in ("", "/", "/a", "/ab", "/b")]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    out = url_filter.judge(pages, url_filter.rule_table(spark, rules))
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {u: expected(u, rules) for u in urls}


def test_no_rules_no_rows_and_clashing_names(spark, pages):
    none = url_filter.rule_table(spark, [])
    assert {r.verdict for r in url_filter.judge(pages, none, default="block").collect()} == {"block"}
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark, url_filter.RULES)).count() == 0
    clashing = pages.selectExpr("*", "'x' AS host", "1 AS rule", "2 AS short", "3 AS digest", "4 AS rule_host")
    out = url_filter.judge(clashing, url_filter.rule_table(spark, url_filter.RULES))
    assert out.count() == pages.count() and out.filter("host = 'x'").count() == 0 and out.filter("short = 2").count() == pages.count()
    own = {"_head": "h", "_best": "b", "_suffix": "s", "_prefix": "p", "_digest": "d", "rule_path": "r"}
    out = url_filter.judge(pages.selectExpr("*", *[f"'{v}' AS {c}" for c, v in own.items()]), url_filter.rule_table(spark, url_filter.RULES))
    assert out.filter(" AND ".join(f"{c} = '{v}'" for c, v in own.items())).count() == pages.count()


def test_no_python_in_the_plan(spark):
    plan = url_filter.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
