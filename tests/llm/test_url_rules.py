import re

import pytest

from lakecart.llm import url_rules as ur

URLS = [
    "http://a.net/x", "http://net/", "http://NET", "https://www.example.net/en/1", "https://example.net/EN/1", "https://bexample.net/en/",
    "http://x.example.com/de/5?q#f", "http://example.com/de", "http://a.org/fr/7#t", "http://a.org:80/fr/", "ftp://u@h.org/fr/", "",
    None, "no scheme", "http://", "https://casino-win.example.com/fr/1", "http://a.casino.b/", "http://my-casino.com/", "http://x/casino/y",
    "http://casinos4u.com/", "http://bet365.com/", "http://a.bet365x.com/", "http://a/ads/b/c.js", "http://tracker.example.com/a",
    "http://a.tracker.com/", "http://mytracker.com/", "http://a.b/wp-login.php", "http://a.b/wp-login.phpx", "http://a.b/privacy/casino/",
    "http://docs.a.com/casino/", "http://a.com/x\n/casino/", "http://a.com/ünï/casino/", "a://b://c.net/d", "http://a.com/pornography",
    "http://xxx.com/", "http://a.com/Casino/",
]


def brute(url, prefix, patterns):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for v, r in prefix for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    own = [(len(r), r, v) for v, r in patterns if re.search(ur.regex_of(r).replace("$)", r"\Z)"), host + path)]
    best, mine = max(fits, default=None), max(own, default=None)
    return host, path, best and best[1], (best or mine or (0, 0, "allow"))[2], None if best else mine and mine[1]


@pytest.mark.parametrize("limit", [ur.BROADCAST_RULES, 0])
def test_by_trying_every_rule(spark, monkeypatch, limit):
    monkeypatch.setattr(ur, "BROADCAST_RULES", limit)
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS + URLS[:5])], "page_id bigint, url string, host string")
    got = {r.page_id: tuple(r)[1:] for r in ur.judge(pages, ur.rule_table(spark)).collect()}
    assert got == {i: brute(u, ur.PREFIX_RULES, ur.PATTERN_RULES) for i, u in enumerate(URLS + URLS[:5])}


def test_literal_tokens():
    assert ur.literal_tokens("||example.net/en/") == ["en", "example", "net"]
    assert ur.literal_tokens("/ads/*.js") == ["ads"]  # js could go on
    assert ur.literal_tokens("||casino*") == [] == ur.literal_tokens("casino*")
    assert ur.literal_tokens("||bet365^") == ["bet365"]
    assert ur.literal_tokens("-Pills.") == ["pills"]


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://www.a.com/{'rare' if i == 3 else 'often'}/{i}") for i in range(10)], "page_id bigint, url string")
    rules = ur.rule_table(spark, prefix=(), patterns=(("block", ".com/rare/"), ("block", "/often/1")))
    out = ur.judge(pages, rules)
    assert [r.page_id for r in out.filter("verdict = 'block'").orderBy("page_id").collect()] == [1, 3]
    # The regular expressions run on candidates only: the joined rows are those of the rarest tokens.
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert ur.judge(none, ur.rule_table(spark)).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/"), (None, None), (1, "http://a.net/")], "page_id bigint, url string")
    rows = ur.judge(one, ur.rule_table(spark, (), ())).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in rows) == [(0, None, "allow"), (1, None, "allow"), (1, None, "allow")]
