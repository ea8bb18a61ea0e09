"""The trie and the join against a brute-force scan of all rules."""

from __future__ import annotations

import random

from eventmarts.llm import url_filter as U

URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.NET/EN/", "https://b.net", "https://b.net/", "net/x",
    "http://x.example.com/de/", "http://example.com/de", "http://example.com/dex", "//y.net/",
    "http://planet/", "http://z.org/fr/?q=://net/", "http://q.net?x=/en/", "http://q.net#/", "://net/",
    None, "", "http://", "http:///path", "http://b.net:80/", "ftp://u@b.net/\n/x",
]


def brute(host: str, path: str, rules) -> tuple[str, str] | None:
    fits = []
    for rule, verdict in rules:
        h, p = U.split_rule(rule)
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((h.count("."), len(p), verdict == "block", rule, verdict))
    return max(fits)[3:] if fits else None


def _check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "other") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string")
    table = spark.createDataFrame(rules + [(None, "block")], "rule string, verdict string")
    by_trie = {r["page_id"]: r for r in U.judge_urls(pages, table).collect()}
    by_join = {r["page_id"]: r for r in U.judge_urls(pages, table, max_broadcast_chars=0).collect()}
    assert by_trie == by_join and len(by_trie) == len(urls)
    for r in by_trie.values():
        want = brute(r["host"], r["path"], rules) or (None, "allow")
        assert (r["rule"], r["verdict"]) == want, r
    return by_trie


def test_rules_of_the_query(spark):
    out = _check(spark, URLS, list(U.RULES))
    assert [out[i]["verdict"] for i in range(4)] == ["allow", "block", "allow", "block"]
    assert (out[14]["host"], out[14]["path"]) == (out[4]["host"], out[4]["path"]) == ("", "")
    assert out[10]["path"] == "/fr/" and out[11]["path"] == ""


def test_random_rules(spark):
    rng = random.Random(3)
    host = lambda: ".".join(rng.choices(["a", "b", "net"], k=rng.randint(1, 3)))
    path = lambda: rng.choice(["", "/", "/a", "/ab/", "/ab/c", "/ab/c/", "//"])
    rules = sorted({host() + path(): rng.choice(["allow", "block"]) for _ in range(25)}.items())
    _check(spark, [f"http://{host()}{path()}{rng.choice(['', 'x', '/y'])}" for _ in range(120)], rules)


def test_block_beats_allow_and_empty_tables(spark):
    rules = [("a/", "allow"), ("a/", "block")]
    table = spark.createDataFrame(rules, "rule string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/"), (1, "http://a/")], "page_id long, url string")
    for most in (0, 100):
        out = U.judge_urls(pages, table, max_broadcast_chars=most).collect()
        assert [r["verdict"] for r in out] == ["block", "block"]
        assert U.judge_urls(pages.limit(0), table, max_broadcast_chars=most).count() == 0
        none = U.judge_urls(pages, table.limit(0), max_broadcast_chars=most).collect()
        assert [r["rule"] for r in none] == [None, None]
