import re

import numpy as np
from pyspark.sql import functions as F

from quarrymark.llm import urlfilter as U

SCHEMA = "page_id long, url string, html string"


def base(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, a) for h, p, a in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, None))
    return host, path, best[2], best[3]


URLS = ["http://a.example.org/es/1", "http://example.org/en/12", "HTTP://EXAMPLE.ORG/en/2?x=/es/", "http://myexample.org/es/", "http://x.com/fr/", "http://x.com/de/a#b", "http://x.com/en/", "http://org", "http://org/", "org/x", None, "", "://", "http://É.ORG/", "http://a://b.org/", "http://x.net/?u=http://y.org/", "http://x.net#f"]


def test_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], "<a href='http://q.net/'>")]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS rule", "'y' AS host", "1 AS rank")
    got = U.filter_urls(pages).collect()
    assert len(got) == len(rows)
    for x in got:
        host, path, rule, action = base(URLS[x.page_id])
        assert (x.host, x.path, x.rule) == (host, path, rule)
        if action:
            assert x.verdict == action


def test_many_rules_are_joined(spark, monkeypatch):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], SCHEMA)
    host, path = U.url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    table = spark.createDataFrame([*U.RULES, (None, "/", "block")], "host string, path string, action string")
    few = sorted(map(tuple, U.with_rules(urls, table).collect()))
    monkeypatch.setattr(U, "MOST_CONSTANT", 2)
    cols = ["page_id", "host", "path", "rule", "action"]
    assert sorted(map(tuple, U.with_rules(urls, table).select(cols).collect()), key=str) == sorted(few, key=str)


def test_joined_rules_against_plain_matching(spark, monkeypatch):
    """Rules of many lengths, clashing as text, with hosts that hold a slash or nothing; repeated urls and clashing columns."""
    monkeypatch.setattr(U, "MOST_CONSTANT", 0)
    rules = [("com", "/", "block"), ("com", "/a", "allow"), ("x.com", "/", "allow"), ("com", "/abc", "block"), ("com", "", "allow"), ("com/", "a", "block"), ("", "/", "block"), ("x.com", "/a", "block"), ("x.com", "/a", "allow"), ("é.com", "/\U0001f600", "block"), ("", "", "allow"), ("COM", "/z/", "block")]
    hosts = ["com", "x.com", "a.x.com", "xx.com", "x.com.", "é.com", "net", ""]
    urls = [(h, p) for h in hosts for p in ("", "/", "/a", "/ab", "/abcd", "/\U0001f600x", "/z/1", "/z")]
    rows = [(i, h, p, "old", {"k": 1}) for i, (h, p) in enumerate([*urls, *urls[:9]])]
    got = U.with_rules(spark.createDataFrame(rows, "_b long, host string, path string, rule string, _salt map<string,int>"), spark.createDataFrame(rules, "host string, path string, action string"))
    assert sorted(got.columns) == ["_b", "_salt", "action", "host", "path", "rule"]
    table: dict = {}
    for h, p, a in rules:
        h = h.lower()
        table[h, p] = max(a, table.get((h, p), ""))
    want = {}
    for i, h, p, *_ in rows:
        fit = [(len(x + y), len(x), x + y, a) for (x, y), a in table.items() if (h == x or h.endswith("." + x)) and p.startswith(y)]
        want[i] = max(fit, default=(0, 0, None, None))[2:]
    assert {r._b: (r.rule, r.action) for r in got.collect()} == want
    assert got.count() == len(rows)


def test_page_rank_against_dense_iteration(spark):
    hosts = "abcdef"
    links = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("d", "c", 1), ("c", "e", 1)]
    seeds = {"a": 3.0, "d": 1.0}
    got = {r.host: r.rank for r in U.propagate(spark.createDataFrame(links, "src string, dst string, n long"), spark.createDataFrame(list(seeds.items()), "host string, weight double"), rounds=8, close=1e-10).collect()}
    m, s = np.zeros((6, 6)), np.array([seeds.get(h, 0) / 4 for h in hosts])
    for a, b, n in links:
        m[hosts.index(b), hosts.index(a)] = n
    out = m.sum(0)
    p = s.copy()
    for _ in range(8):
        p = 0.15 * s + 0.85 * (m @ (p / np.where(out > 0, out, 1)) + p[out == 0].sum() * s)
    assert abs(sum(got.values()) - 1) < 1e-6
    assert all(abs(got.get(h, 0) - p[i]) < 1e-6 for i, h in enumerate(hosts))


def test_ranks_are_those_of_the_limit(spark):
    hosts = "abcdef"
    links = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("d", "c", 1), ("c", "e", 1)]
    seeds = {"a": 3.0, "d": 1.0}
    got = {r.host: r.rank for r in U.propagate(spark.createDataFrame(links, "src string, dst string, n long"), spark.createDataFrame(list(seeds.items()), "host string, weight double"), close=1e-3).collect()}
    m, s = np.zeros((6, 6)), np.array([seeds.get(h, 0) / 4 for h in hosts])
    for a, b, n in links:
        m[hosts.index(b), hosts.index(a)] = n
    out = m.sum(0)
    p = s.copy()
    for _ in range(300):
        p = 0.15 * s + 0.85 * (m @ (p / np.where(out > 0, out, 1)) + p[out == 0].sum() * s)
    assert sum(abs(got.get(h, 0) - p[i]) for i, h in enumerate(hosts)) < 2e-3 and abs(sum(got.values()) - 1) < 1e-9


def test_ranks_reach_hosts_at_the_end_of_long_paths(spark):
    links = [(f"h{i}", f"h{i + 1}", 1) for i in range(24)]
    got = {r.host: r.rank for r in U.propagate(spark.createDataFrame(links, "src string, dst string, n long"), spark.createDataFrame([("h0", 1.0)], "host string, weight double"), close=0.5).collect()}
    total = sum(0.85**i for i in range(25))
    assert len(got) == 25 and all(abs(got[f"h{i}"] - 0.85**i / total) < 1e-9 for i in range(25))


def test_links_without_a_scheme_are_edges(spark):
    html = """<a href="//Other.net/x"> <img src=//cdn.net/z> <a href='https://b.org'> <a href="/a//b.net/"> <a href="x//c.net"> <a href="//own.org/">"""
    pages = spark.createDataFrame([("own.org", html), ("p.org", '<a href="//q.net">'), ("n.org", None)], "host string, html string")
    got = sorted(map(tuple, U.host_edges(pages).collect()))
    assert got == [("own.org", "b.org", 1), ("own.org", "cdn.net", 1), ("own.org", "other.net", 1), ("p.org", "q.net", 1)]


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    bad = "".join(f'<a href="http://spam.com/de/{k}">x</a>' for k in range(3))
    rows = [(1, "http://spam.com/de/1", ""), (2, "http://farm.net/", bad), (3, "http://good.org/", '<a href="https://Nice.net/x">y</a><img src=//cdn.net/z>'), (4, "http://nice.net/", None), (5, "http://alone.net/", '<a href="/rel">')]
    got = {x.page_id: x.verdict for x in U.filter_urls(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_empty_table(spark):
    assert U.filter_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_of_any_type(spark):
    pages = spark.createDataFrame([("p one", "http://a.org/x", None), (None, "http://b.com/fr/", None)], "page_id string, url string, html string")
    assert {(r.page_id, r.verdict) for r in U.filter_urls(pages).collect()} == {("p one", "allow"), (None, "allow")}
