from __future__ import annotations

import random

from pyspark.sql import functions as F

from texloom.llm import url_filter as U

from .helpers import written


def _plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:n].translate(str.maketrans(U.UPPER, U.LOWER)), rest[n:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h) or h == "") and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


URLS = ["http://WWW.Example.com/en/1", "https://example.com/en/", "https://example.com/en", "http://a.b.example.com/EN/x?q#f", "http://x.net/es/a",
        "http://net/fr/", "http://notnet/fr/", "http://example.com", "http://example.com?x", "http://example.com/#a", "nothing", "", None, "://", "http:///p",
        "ftp://é.com/é/ü", "http://x.com:80/", "http://user@x.com/", "http://a.com/b://c.net/es/", "http://.com/", "http://com./", "a://b\nc.com/d\ne",
        "http://x.com/" + "s/" * 20_000]


def _out(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_registered_rules(spark, scratch):
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate([*URLS, *URLS])], "page_id long, url string, html string")
    sf = written(spark, scratch, {"pages": pages})
    want = sorted(((k, *_plain(u, U.RULES)) for k, u in enumerate([*URLS, *URLS])), key=repr)
    assert _out(U.op9_url_filter(spark, sf)) == want


def test_random_rules_trie_and_join(spark):
    r = random.Random(6)
    hosts, paths = ["", "com", "a.com", "b.a.com", "net", "x.net"], ["", "/", "/a", "/a/", "/a/b", "/ab", "/a/b/"]
    for _ in range(3):
        rules = list({(h, p): (r.choice(["allow", "block"]), h, p) for h in hosts for p in paths if r.random() < 0.4}.values())
        urls = [f"http://{r.choice(['', 'b.', 'c.b.'])}{r.choice(['a.com', 'com', 'x.net', 'q.org'])}{r.choice(['', '/', '/a', '/a/', '/ab', '/a/b', '/a/b/c', '/abc/d', '/c'])}"
                for _ in range(120)]
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("HOST", F.lit("h")).withColumn("x y", F.lit(1))
        want = sorted(((k, u, 1, *_plain(u, rules, "block")) for k, u in enumerate(urls)), key=repr)
        one = U.url_filter(df, rules, default="block")
        assert one.columns == ["page_id", "url", "x y", "host", "path", "rule", "verdict"]
        assert _out(one) == want
        table = spark.createDataFrame(rules, "verdict string, host string, path string")
        assert _out(U.url_filter_join(df, table, default="block")) == want


def test_empty_tables_and_bounds(spark):
    import pytest
    df = spark.createDataFrame([], "page_id long, url string")
    assert U.url_filter(df, U.RULES).collect() == []
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert U.url_filter(some, []).collect()[0].verdict == "allow"
    with pytest.raises(ValueError):
        U.url_filter(some, U.RULES, max_rules=2)
