"""URL filter: both forms against plain prefix tests, and the array's file."""

import pytest
import xxhash

from vecloom.llm import url_filter
from vecloom.llm.queries import URL_RULES

URLS = [
    "http://www.example.com/en/1", "https://example.com/en/", "http://EXAMPLE.com/en", "ftp://a.b.example.com/en/x?y#z", "http://com",
    "http://x.net/es/1", "http://net/fr/#a", "http://internet/es/1", "no scheme", None, "", "http://", "http:///en/", "x://y://z/es/",
    "http://example.com?/en/", "http://é.net/es/ü", "http://x.net/de/" + "a" * 5000,
]


def plain(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, tail = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
    fits = [(h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, action = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
    return host, path, rule, action


@pytest.mark.parametrize("most", [url_filter.MAX_ARRAY_RULES, 2])
def test_both_forms_equal_plain_tests(spark, most):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)], "page_id int, url string, rule string")
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    rows = url_filter.filter_urls(pages, rules, max_array_rules=most).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got == {i: plain(u) for i, u in enumerate(URLS)}


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame([], "action string, host string, path string")
    pages = spark.createDataFrame([("http://a.b/c",)], "url string")
    assert [(r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, default="block").collect()] == [(None, "block")]
    assert url_filter.filter_urls(pages.where("false"), rules).count() == 0


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda key: 7)
    file = tmp_path / "rules.bin"
    file.write_bytes(url_filter.pack_rules([("allow", "a.b", "/"), ("block", "c.d", "/x"), ("block", "a.b", "/y")]))
    array = url_filter.RuleArray(str(file))
    at = array.find([b"c.d/x", b"a.b/y", b"a.b/", b"e.f/"])
    assert [array.full(int(j)) if j >= 0 else None for j in at] == [b"c.d/x", b"a.b/y", b"a.b/", None]
    assert [bool(array.blocks[j]) for j in at[:3]] == [True, True, False]
