import random

import pytest

from tallyforge.llm import urlfilter as uf

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("org", "", "block")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[at:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at]), tail[:end]


def brute(url, rules):
    host, path = parts(url)
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return host, path, None, "allow"
    key = max(fit)[2]
    return host, path, key, "block" if any(v != "allow" for *_, k, v in fit if k == key) else "allow"


def urls(n, seed):
    rng = random.Random(seed)
    hosts = ["com", "example.com", "WWW.Example.com", "a.www.example.com", "xexample.com", "b.net", "net", "x.org", "é.org", "host:80.com", ""]
    paths = ["", "/", "/en", "/en/", "/en/1", "/es/x?q=/en/", "/es#top", "?/en/", "#/", "/EN/", "/é/x\ny"]
    return [f"{rng.choice(['http', 'HTTPS', 'a://b'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(n)]


def frames(spark, found, rules):
    pages = spark.createDataFrame([(k, u, "mine", "h") for k, u in enumerate(found)], "page_id bigint, url string, rule string, host string")
    return pages, spark.createDataFrame(rules, "host string, path string, verdict string")


@pytest.mark.parametrize("filter_bytes", [uf.FILTER_BYTES, 4])
def test_judged_matches_brute_force(spark, filter_bytes):
    found = [None, "", "no scheme/en/", "://", "http://", "http://example.com", "x" * 70_000 + "://example.com/en/" + "y" * 70_000, "http://" + "a." * 40_000 + "example.com/en/", *urls(300, 1)]
    found += [found[-1]] * 50
    pages, rules = frames(spark, found, RULES)
    out = uf.judged(pages, rules, filter_bytes=filter_bytes)
    assert out.columns == ["page_id", "url", "rule", "host", "host_", "path", "rule_", "verdict"]  # its own columns pass through
    assert {r.page_id: (r.host_, r.path, r.rule_, r.verdict) for r in out.collect()} == {k: brute(u, RULES) for k, u in enumerate(found)}
    assert {(r.rule, r.host) for r in out.collect()} == {("mine", "h")}


def test_odd_rules_and_empty_tables(spark):
    found = ["http://a.com/x", "http://b.a.com/x/y", "http://a.com"]
    odd = [(None, "/", "block"), ("a.com", None, "block"), ("a.com", "/", None), ("a.com", "x", "block"), ("", "/", "block")]
    pages, rules = frames(spark, found, odd)
    assert {(r.rule_, r.verdict) for r in uf.judged(pages, rules).collect()} == {(None, "allow")}
    both = [("A.com", "/x", "allow"), ("a.com", "/x", "block"), ("b.a.com", "", "allow"), ("a.com", "/x", "block")]
    pages, rules = frames(spark, found, both)
    got = {r.page_id: (r.rule_, r.verdict) for r in uf.judged(pages, rules).collect()}
    assert got == {0: ("a.com/x", "block"), 1: ("b.a.com", "allow"), 2: (None, "allow")}  # of two rules of 7 characters the longer host's
    assert uf.judged(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in uf.judged(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(3)
    names = [f"k{rng.randrange(10**9)}" for _ in range(6000)]
    listed = spark.createDataFrame([(x,) for x in names[:1500]], "key string")
    others = spark.createDataFrame([(x,) for x in names[1500:]], "key string")
    cascade = uf.Cascade(listed, lambda f: others.where(f.passes(others["key"])), first=(2, 1), later=(2, 1))
    assert len(cascade.filters) >= 4
    assert listed.where(~cascade.has(listed["key"])).count() == 0
    assert others.where(cascade.has(others["key"])).count() == 0


def test_plan_has_neither_join_nor_exchange_nor_python(spark):
    pages, rules = frames(spark, urls(20, 2), RULES)
    plan = uf.judged(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Join", "Exchange", "Python", "Arrow", "from_json"))
