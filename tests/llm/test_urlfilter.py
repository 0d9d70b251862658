"""Url rules against a plain loop over all rules."""

import re

import pytest

from starmart.llm import urlfilter

RULES = [
    *urlfilter.DEFAULT,
    urlfilter.Rule("digits", r"[0-9]{4}", "block"),  # no token: every url runs it
    urlfilter.Rule("tie-a", r"/tie/", "allow"), urlfilter.Rule("tie-b", r"/tie/", "block"),
    urlfilter.site("example.com/", "allow"),
]


def plain(url, rules):
    host = path = ""
    hits = []
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        target = host.translate(str.maketrans(urlfilter._UPPER, urlfilter._LOWER)) + rest[len(host):]
        host = target[: len(host)]
        hits = [(r.rank, len(r.name), r.name, r.verdict) for r in rules if re.search(r.pattern, target)]
    best = max(hits, default=None)
    site = best[2] if best and best[0] else None
    return host, path, site, best[3] if best else "allow", best[2] if best else None


URLS = [
    None, "", "example.net/en/", "://", "http://", "https:///x", "http://net", "http://net/", "http://NET/a?b", "http://a.b.Example.NET/en/1",
    "http://example.net/en", "http://example.net/EN/1", "http://xexample.net/en/1", "http://www.example.com/de/1?x://y/z", "http://example.com/fr/1#top",
    "http://example.org/fr/", "http://org/fr/x", "http://notorg/fr/x", "ftp://u:p@example.net:80/en/", "http://shop.cheap-pills.io/", "http://a.io/tie/",
    "http://a.io/x.JPG", "http://a.io/x.jpg", "http://a.io/x.jpg?y", "http://a.io/wp-admin/", "http://a.io/search/q", "http://a.io/research/q", "http://a.io/?print=yes",
    "http://ä.io/löschen?sid=1", "http://a.io/1234", "http://a.io/" + "x/" * 50_000 + "robots.txt", "http://a.io/robots.txt", "http://a.io/\n/cart", "http://CASINO.io/",
]


@pytest.mark.parametrize("rules", [RULES, RULES[:4], []])
def test_verdicts(spark, rules):
    data = [(i if i % 7 else None, u, "clash", "clash", "clash") for i, u in enumerate(URLS)] + [(1, URLS[7], None, None, None)] * 3
    pages = spark.createDataFrame(data, "page_id long, url string, rule string, own string, `token` string")
    found = urlfilter.judge(pages, rules)
    assert found.columns == ["page_id", "url", "own", "token", "host", "path", "rule", "verdict", "pattern"]
    got = sorted(map(repr, ((r.page_id, r.url, r.host, r.path, r.rule, r.verdict, r.pattern) for r in found.collect())))
    assert got == sorted(map(repr, ((k, u, *plain(u, rules)) for k, u, *_ in data)))
    assert urlfilter.judge(pages.limit(0), rules).isEmpty()
    assert urlfilter.judge(pages.select("url"), rules).count() == len(data)


def test_tokens():
    assert urlfilter.mandatory_tokens(urlfilter.site("example.net/en/", "x").pattern) == [{"example", "net", "en"}]
    assert urlfilter.mandatory_tokens("/a(?:b|c)/") == [{"ab"}, {"ac"}]
    for without in ("abc", "/abc", "[0-9]+", "/(?:abc/)?", "/a.c/", "/a[0-9]*/", "/(?:abc/|x)", "[^a-z0-9]abc/"):
        assert not all(urlfilter.mandatory_tokens(without)), without
    assert urlfilter.mandatory_tokens("[^A-Za-z0-9]Abc/") == [{"abc"}] and urlfilter.mandatory_tokens("(?:/abc/){2,}") == [{"abc"}]
    assert urlfilter.mandatory_tokens("^abc$") == [{"abc"}]


@pytest.mark.parametrize("broadcast", [urlfilter.BROADCAST, 0])
def test_index_is_by_the_rarest_token(spark, monkeypatch, broadcast):
    monkeypatch.setattr(urlfilter, "BROADCAST", broadcast)
    pages = spark.createDataFrame([("http://a.net/x/",)] * 3 + [("http://a.net/y/",), ("http://b.io/x/",)], "url string")
    rows = pages.select(urlfilter.host_and_path(pages.url)[2].alias("target"))
    rules = [urlfilter.Rule("one", "/(?:x|y)/$", "block"), urlfilter.site("a.net/x/", "block")]
    got = sorted((r.name, r.token) for r in urlfilter.rule_index(rows, rules).collect())
    assert got == [("a.net/x/", "net"), ("one", "x"), ("one", "y")] or got == [("a.net/x/", "a"), ("one", "x"), ("one", "y")]
