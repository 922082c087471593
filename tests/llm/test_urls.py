import random

import pytest

from strata.llm import url_redirects as U

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize(
    "url, target, address",
    [
        ("http://a.com/b/c.html?x=1#y", "page-2.html", "http://a.com/b/page-2.html"),
        ("http://a.com/b/c.html?x=1", "?id=3", "http://a.com/b/c.html?id=3"),
        ("http://a.com/b/c/d", "../x", "http://a.com/b/x"), ("http://a.com/b/", "./x/../y", "http://a.com/b/y"),
        ("http://a.com", "x", "http://a.com/x"), ("https://a.com/b", "//c.org/d", "https://c.org/d"), ("https://a.com/b", "/d", "https://a.com/d"),
        ("http://a.com/", "http://b.org/?p=1&amp;q=2", "http://b.org/?p=1&q=2"),
        ("http://a.com/", "/caf&eacute;&#x2F;&#47;z", "http://a.com/café//z"), ("http://a.com/", " HTTP://B.org/x ", "http://B.org/x"),
        ("http://a.com/", "#top", None), ("http://a.com/", "", None), ("http://a.com/", "mailto:x@y.z", None),
        ("http://a.com/", "javascript:go()", None), ("http://a.com/", "http://[b", None), ("no scheme", "x", None), (None, "http://b.org/", None),
    ],
)
def test_targets(url, target, address):
    assert U.resolve(url, target) == address


def test_stated_links_of_all_forms(spark):
    page = (
        "<link rel='stylesheet' href='/s.css'><LINK href=next.html rel=canonical><meta http-equiv=\"Refresh\" content=\"0; URL=../up\">"
        "<meta http-equiv=refresh content='5;url=\"/q?a=1&amp;b=2\"'><meta name=description content='url=/no'><link rel=canonical>"
    )
    pages = spark.createDataFrame([(1, "http://a.com/b/c/d", page), (2, None, page), (3, "http://a.com/", None)], PAGES)
    got = {(r.url, r.target) for r in U.alias_links(pages).collect()}
    assert got == {("http://a.com/b/c/d", f"http://a.com/{x}") for x in ("b/c/next.html", "b/up", "q?a=1&b=2")}


def test_redirects_against_union_find(spark):
    """100,000 edges: chains, stars and loops, with blocked ends and allowed pages inside."""
    rng = random.Random(7)
    n = 60_000
    site = lambda k: f"http://s{k % 9}.net/{'a' * (k % 3)}{k}"
    edges = [(k, k + 1) for k in range(0, 400)] + [(1000, k) for k in range(1001, 21_000)] + [(k, k + 1) for k in range(21_000, 60_000, 2)]
    edges += [(rng.randrange(22_000, n), rng.randrange(22_000, n)) for _ in range(8000)]
    edges += [(b, a) for a, b in rng.choices(edges, k=100_000 - len(edges))]
    blocked, allowed = [400, 20_999, 30_000, 45_001], [5, 1500, 30_001]
    rules = tuple(U.Rule("block", site(k)[7:]) for k in blocked) + tuple(U.Rule("allow", site(k)[7:]) for k in allowed)

    parent = list(range(n + 1))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)

    def own(k):
        fits = [r for r in rules if site(k)[7:].startswith(r.host + r.path)]
        return max(fits, key=lambda r: len(r.text)).verdict if fits else None

    bad = {find(k) for k in range(n + 1) if own(k) == "block"}
    pages = spark.createDataFrame([(k, site(k), "") for k in range(0, n, 3)], PAGES)
    redirects = spark.createDataFrame([(site(a), site(b)) for a, b in edges] + [(None, "http://x.y/"), ("http://x.y/", None)], "url string, target string")
    got = {r.page_id: r.verdict for r in U.judge(pages, rules, redirects).collect()}
    assert got == {k: own(k) or ("block" if find(k) in bad else "allow") for k in range(0, n, 3)}
    assert {"allow", "block"} == set(got.values()) and got[1500] == "allow" and got[1503] == "block"
