"""URL filters: the cascade against plain rules, with the awkward rows."""

from __future__ import annotations

import random
import re

import pytest

from labelloom.llm import urls
from labelloom.llm.queries import URL_RULES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    return host.translate(LOW), re.split(r"[?#]", rest[len(host):])[0]


def judge(url, rules):
    host, path = parts(url)
    fits = [((len(h) + len(p or ""), len(h)), h + (p or ""), a) for h, p, a in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    if not fits:
        return host, path, None, "allow"
    best = max(f[0] for f in fits)
    top = [f for f in fits if f[0] == best]
    return host, path, top[0][1], "block" if any(f[2] == "block" for f in top) else "allow"


def run(spark, pages, rules):
    table = spark.createDataFrame([(i, u, "h", "p", "r", 1) for i, u in pages],
                                  "page_id long, url string, host string, path string, rule string, key int")
    given = spark.createDataFrame(rules, "host string, path string, action string")
    return sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(table, given).collect()), key=repr)


def expected(pages, rules):
    return sorted(((i, *judge(u, rules)) for i, u in pages), key=repr)


ODD = [(1, None), (2, ""), (3, "no scheme net/"), (4, "://net/"), (5, "http://net"), (6, "http://net?x=/"), (7, "HTTP://A.NET/x?y#z"),
       (8, "http://example.net/en/"), (9, "http://example.net/en"), (10, "http://xexample.net/en/1"), (11, "http://a.example.net/en/?q"),
       (12, "http://example.com/de/a"), (13, "http://example.com/DE/a"), (14, "http://example.org/fr/"), (15, "http://org/fr/x"),
       (16, "http://net.org/"), (17, "http://netx/"), (18, "http://.net/"), (19, "x://y://net/"), (20, "http://net:80/"),
       (21, "http://é.net/ü?ß"), (22, "http://a\n.net/b\nc"), (11, "http://a.example.net/en/?q"), (None, "http://net/"), (None, None),
       (23, "http://" + "a." * 100_000 + "net/" + "x" * 100_000), (24, "http://example.net#/en/")]


def test_rules_of_the_query(spark):
    assert run(spark, ODD, URL_RULES) == expected(ODD, URL_RULES)


def test_no_pages_no_rules(spark):
    assert run(spark, [], URL_RULES) == []
    assert run(spark, [(1, "http://net/")], []) == [(1, "net", "/", None, "allow")]
    odd = [(None, "/", "block"), ("", "/", "block"), ("net", "/", "refuse"), ("a/b", "", "block"), ("net", "x", "block"), ("net", None, None)]
    assert run(spark, [(1, "http://net/")], odd) == [(1, "net", "/", None, "allow")]


def random_case(seed, n_rules, n_pages):
    r = random.Random(seed)
    labels = ["a", "b", "cc", "ddd", "net", "org"]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randint(1, 4)))
    path = lambda: "".join("/" + r.choice(["x", "yy", "z1", "en"]) for _ in range(r.randint(0, 3))) + r.choice(["", "/"])
    rules = [(host(), path(), r.choice(["allow", "block"])) for _ in range(n_rules)]
    pages = [(i, f"http://{host()}{path()}{r.choice(['', '?q=1', '#f'])}") for i in range(n_pages)]
    return pages, [(h, p if p.startswith("/") else "", a) for h, p, a in rules]


@pytest.mark.parametrize("n_rules, keys", [(300, urls.KEYS), (200, 50)])
def test_many_rules(spark, monkeypatch, n_rules, keys):
    monkeypatch.setattr(urls, "KEYS", keys)
    pages, rules = random_case(n_rules, n_rules, 1500)
    # A key with both actions blocks, whatever the order; so does the plain judge.
    assert run(spark, pages, rules) == expected(pages, rules)


def test_cascade_is_exact(spark):
    """No listed key is missed and no other key of the universe is taken, over several levels."""
    universe = spark.range(20_000).selectExpr("concat('k', id % 15000) as key")
    listed = spark.range(0, 15_000, 37).selectExpr("concat('k', id) as key")
    known = urls.cascade(listed, universe)
    assert len(known.levels) >= 3
    got = {r["key"] for r in universe.filter(known.holds(universe["key"])).collect()}
    assert got == {f"k{i}" for i in range(0, 15_000, 37)}
    assert sum(len(level.bits) for level in known.levels) < 2_000


def test_pages_are_not_joined(spark):
    """The plan over the pages has no join, no shuffle and no Python."""
    table = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    text = urls.judge_urls(table, rules)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Join|Exchange|Python|Arrow", text)
