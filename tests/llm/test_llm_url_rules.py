import re

import pytest

from cohortwise.llm import url_rules as urls
from cohortwise.llm.queries import QUERIES

PLACES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def slow(url):
    """host, path, rule, verdict, pattern by trying every rule."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        tail = rest[len(host):]
        path = re.match(r"[^?#]*", tail)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v == "block", v, (h + p)) for v, h, p in PLACES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, _, verdict, rule = max(fits)
        return host, path, rule, verdict, None
    name = next((r.name for r in urls.PATTERNS if url is not None and re.search(r.pattern, url.lower())), None)
    return host, path, None, "block" if name else "allow", name


URLS = [None, "", "no scheme", "http://", "http://x.net", "http://x.net/", "http://net/a", "http://aanet/x", "https://Example.NET/en/page", "http://example.net/EN/x",
        "http://a.example.net/en", "http://a.b.example.com/de/x?y#z", "http://example.com/de", "http://x.org/fr/", "http://org/fr/x", "http://borg/fr/x", "http://x.org?/fr/",
        "http://x.org#/fr/", "ftp://free-bets.example.com/en/", "http://www.casino-win.example.com/", "http://notcasino.com/", "http://cheap-pills.example.net/en/x",
        "http://a.net:80/x", "http://user@x.net/y", "http://x.com/://y.net/", "http://ünïcode.net/é/x", "://x.net/", "http://spam-farm.example.org/fr/x", "http://ads-track.example.com/x",
        "http://xxx.example.com/", "http://x.com/viagra/", "http://x.com/" + "a/" * 20_000, "http://x.com/casino", "a\nhttp://y.net/\nz", "http://live-bets.x/"]


def test_urls(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[10], None), (3, URLS[3], "x")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *slow(u)) for i, u, _ in rows), key=str)


def test_rules_are_filed_under_their_rarest_token():
    places = [urls.place_rule("block", "example.net/en/")]
    assert list(urls.index(places, {"example": 9, "net": 3, "en": 5})) == ["net"]
    assert list(urls.index(places, {"example": 9, "net": 3})) == ["en"]
    with pytest.raises(ValueError):
        urls.index([urls.pattern_rule("x", ".")], {})


def test_longest_rule_wins_and_block_among_equals(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/x/y")], "page_id long, url string")
    places = [urls.place_rule("allow", "b.c/x/"), urls.place_rule("block", "c/x/y"), urls.place_rule("block", "c/")]
    assert [(r.rule, r.verdict) for r in urls.judge(pages, places, []).collect()] == [("b.c/x/", "allow")]
    places = [urls.place_rule("allow", "b.c/x"), urls.place_rule("block", "c/x/y")]
    assert [(r.rule, r.verdict) for r in urls.judge(pages, places, []).collect()] == [("c/x/y", "block")]


def test_bounds_and_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(empty).collect() == []
    with pytest.raises(ValueError):
        urls.judge(empty, urls.PLACES * 1000)


def test_no_python_runs(spark, small, capsys):
    QUERIES["op8_rarest_token_rules"](spark, small).explain("formatted")
    assert not re.search("Python|Arrow|Exchange", capsys.readouterr().out)


def test_query_equals_brute_force(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert {tuple(r) for r in QUERIES["op8_rarest_token_rules"](spark, small).collect()} == {(p.page_id, *slow(p.url)) for p in pages}


def test_letters_beyond_ascii_next_to_a_literal(spark):
    found = ["http://écasino-win.example.com/", "http://x.com/éviagraé/", "http://x.com/ñpornñ/", "http://x.com/漢viagra漢"]
    got = urls.judge(spark.createDataFrame(list(enumerate(found)), "page_id long, url string")).collect()
    assert sorted(tuple(r) for r in got) == [(i, *slow(u)) for i, u in enumerate(found)]
    assert {r.verdict for r in got} == {"block"}
