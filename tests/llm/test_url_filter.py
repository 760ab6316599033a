"""URL filter against plain Python."""

from __future__ import annotations

import re

from tessera.llm.url_filter import RULES, SOFT, SOFT_LIMIT, STRICT, judge_urls

URLS = [
    None, "", "no scheme.net/", "http://NET", "http://net/", "https://a.net/x?y#z", "http://planet/", "http://example.net/en/x", "http://w.Example.NET/en/", "http://example.net/en",
    "http://example.net/EN/", "http://example.com/de/1", "http://notexample.com/de/1", "x://a.org/fr/?q=casino", "x://a.org/fr?q=casino", "http://example.com?x://b.net/", "a://b://c.net/",
    "http://h.com/cheap-pills", "http://h.com/cheap/cheap", "http://h.com/CASINO", "http://h.com/casinos", "http://adult.win/", "http://h.com/farm-free-cheap", "http://h.com/farm.free",
    "http://casino.net/", "http://www.example.net/en/casino", "casino", "http://h.com/été-xxx", "http://h.com/éxxx", "http://u@h.net:80/", "http://\n/a", "http://h.com/" + "a/" * 4000 + "viagra",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), a, r) for a, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    terms = {t for t in [*STRICT, *SOFT] if re.search(rf"(?<![^\W_]){t}(?![^\W_])", (url or "").lower())}
    own = "block" if terms & set(STRICT) or sum(SOFT.get(t, 0) for t in terms) >= SOFT_LIMIT else "allow"
    return host, path, max(fits)[2] if fits else None, max(fits)[1] if fits else own, sorted(terms)


def test_matches_plain_python(spark, clashing):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["terms"]) for r in judge_urls(clashing(pages)).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}


def test_empty_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/casino"), (2, None)], "page_id long, url string")
    assert judge_urls(pages.where("false")).collect() == []
    rows = judge_urls(pages, rules=(), strict=(), soft={}).collect()
    assert [(r["rule"], r["verdict"]) for r in rows] == [(None, "allow"), (None, "allow")]
