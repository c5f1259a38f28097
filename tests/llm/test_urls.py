from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from aerolake.llm import urls


def test_split_and_rules(spark):
    cases = [
        ("http://A.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://a.example.net/de/1", "a.example.net", "/de/1", "net/", "block"),
        ("http://example.net", "example.net", "", None, "allow"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("x://b.example.com/de/#f", "b.example.com", "/de/", "example.com/de/", "block"),
        ("https://w.org/fr/a?b#c", "w.org", "/fr/a", "org/fr/", "allow"),
        ("no scheme/x", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("://", "", "", None, "allow"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ]
    rows = [(i, c[0], None, "x", "y") for i, c in enumerate(cases)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")
    made = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert made == {i: c[1:] for i, c in enumerate(cases)}
    assert urls.judge(pages.limit(0)).count() == 0
    assert urls.judge(pages.unionByName(pages).withColumn("page_id", F.lit(None).cast("long"))).count() == 22


def test_propagation(spark):
    """Against whole-number PageRank in plain Python, forward and reversed."""
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c"), ("e", "d")]
    rows = [("allow", s, t) for s, t in edges] + [("block", t, s) for s, t in edges]
    seeds = [("allow", "a", 600), ("allow", "e", 400), ("block", "c", 1000)]
    seeds = [(k, h, n * 10**9) for k, h, n in seeds]
    made = urls.propagate(
        spark.createDataFrame(seeds, "kind string, host string, seed long"),
        spark.createDataFrame(rows, "kind string, source string, target string"),
        rounds=7,
    )
    scores = {(k, h): n for k, h, n in seeds}
    for _ in range(7):
        new: dict = defaultdict(int)
        for k, h, n in seeds:
            new[k, h] += n * 15 // 100
        for k, s, t in rows:
            if (k, s) in scores:
                new[k, t] += scores[k, s] * 85 // (100 * sum(1 for a, b, _ in rows if (a, b) == (k, s)))
        scores = new
    assert {(r.kind, r.host): r.score for r in made.collect()} == dict(scores)


def test_links_carry_trust_and_distrust(spark):
    """A host that a trusted one links to is allowed; one that links to a blocked one is blocked."""
    rows = [
        (1, "http://good.org/fr/", '<a href="https://Friend.com/x">'),
        (2, "http://friend.com/", "<a href='/own'>"),
        (3, "http://shady.com/", '<a href="//bad.net/">'),
        (4, "http://bad.net/", None),
        (5, "http://lone.com/", '<a href="http://nowhere.example/">'),
        (6, "http://sub.shady.com/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = {r.page_id: r.verdict for r in urls.judge(pages).collect()}
    assert made == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "block"}


def test_targets_without_pages(spark):
    """A rule on a linked address works where the address, or its whole host, has no page."""
    rows = [
        (1, "http://shady.com/", '<a href="//Bad.net/x">'),
        (2, "http://sly.com/", "<a href='https://a.example.com/de/x?q'>"),
        (3, "http://fair.com/", "<a href=//a.example.com/it/x>"),
        (4, "http://good.org/fr/", '<a href="http://friend.com/"> <a href="http://far.away/"> <a href="//bad.net/y">'),
        (5, "http://friend.com/", ""),
        (6, "nowhere", '<a href="//bad.net/z">'),
        (7, "http://a.example.com/en", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = {r.page_id: r for r in urls.judge(pages, rounds=1).collect()}
    assert [made[i].verdict for i in (1, 2, 4, 5, 6)] == ["block", "block", "allow", "allow", "allow"]
    share = urls.UNIT // 3  # bad.net/x, bad.net/y and a.example.com/de/x are the blocked addresses
    assert made[1].distrust == 2 * share * 85 // 200 and made[4].distrust == made[1].distrust
    assert made[2].distrust == share * 85 // 200 and made[3].distrust == made[2].distrust
    assert made[7].distrust == share * 15 // 100
    assert made[5].trust == urls.UNIT * 85 // 300  # one of three linked hosts


def test_an_address_counts_once(spark):
    """Links to an address that has a page, and repeated links, add no seeds."""
    link = '<a href="http://bad.net/x"> <a href="http://bad.net/x#a"> <a href="//bad.net/x?b">'
    rows = [(1, "http://a.com/", link), (2, "http://b.com/", link), (3, "http://bad.net/x", None), (4, "http://c.net/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = {r.page_id: r for r in urls.judge(pages, rounds=1).collect()}
    assert made[3].distrust == made[4].distrust == urls.UNIT // 2 * 15 // 100
    assert made[1].distrust == made[2].distrust == urls.UNIT // 2 * 85 // 200


def test_links_in_any_form(spark):
    """Case, blanks around the sign, a user part and a default port hide no host; another port is another server."""
    links = ['HREF="//bad.net/"', "href = 'HTTP://bad.net/'", 'Src=\n"https://user:word@BAD.net:443/"', "href=//bad.net:80"]
    rows = [(i, f"http://h{i}.com/", f"<a {link}>") for i, link in enumerate(links)]
    rows += [(8, "http://bad.net/", ""), (9, "http://h9.com/", '<a href="//bad.net:81/">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = {r.page_id: r.verdict for r in urls.judge(pages).collect()}
    assert made == {0: "block", 1: "block", 2: "block", 3: "block", 8: "block", 9: "allow"}


def test_a_page_among_very_many_seeds_is_heard(spark):
    """One of 10^11 seed pages still reaches hosts behind three hubs of 1,000 links each."""
    hops = [("a", "b"), ("b", "c"), ("c", "d")]
    edges = [("allow", s, t) for s, t in hops] + [("allow", s, f"{s}{i}") for s, _ in hops for i in range(999)]
    seeds = [("allow", "a", Decimal(urls.UNIT // 10**11))]
    made = urls.propagate(
        spark.createDataFrame(seeds, f"kind string, host string, seed {urls.SCORE}"),
        spark.createDataFrame(edges, "kind string, source string, target string"),
        rounds=4,
    )
    share = urls.UNIT // 10**11 * 15 // 100
    expected = {"a": share}
    for s, t in hops:
        expected[t] = expected[s] * 85 // 100_000
    scores = {r.host: r.score for r in made.collect()}
    assert {h: scores[h] for h in expected} == expected and expected["d"] > 10**6
