from __future__ import annotations

import re
from collections import Counter

import pytest

from feedquality.llm import url_filter as u

URLS = [
    "http://www.example.com/en/1", "http://example.com/en/1", "http://a.b.example.com/en/", "http://example.com/de/x?y=/en/",
    "https://example.com", "http://x.net/es/1", "http://x.net/fr", "http://x.net/fr/#a", "http://NET/es/", "http://xnet/es/1",
    "http://m.Free-Bets.example.org/a", "http://cheap-pills.example.org?x", "http://cheap.pills.org/", "http://x.org/CASINO/",
    "http://porn.example.org/", "http://a.org/login.php", "http://a.org/?print=1", "http://a.org/?PHPSESSID=2",
    "no scheme", "", None, "://", "x://h?://y/z", "http://a\nb.org/p\nq?r", "http://x.org/?utm_source=a&b=1&utm_campaign=c",
    "http://spam-farm.example.org/" + "a/" * 5000, "http://x.com:80/a", "http://u@example.com/en/", "http://adult-x.org/",
]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [r for r in u.PATH_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    matching = sorted(r.name for r in u.PATTERN_RULES if url is not None and re.search(r.pattern, url))
    return (host, path, best and best.host + best.path, matching[0] if matching else None,
            best.verdict if best else "block" if matching else "allow")


def frame(spark, urls):
    return spark.createDataFrame([(i, x, "h", "r") for i, x in enumerate(urls)],
                                 "page_id long, url string, host string, rule string")


def run(df):
    return Counter((r["page_id"], r["host"], r["path"], r["rule"], r["pattern_rule"], r["verdict"]) for r in u.judge(df).collect())


def test_verdicts(spark):
    pages = frame(spark, URLS + URLS[:5])
    assert run(pages) == Counter((i, *brute(x)) for i, x in enumerate(URLS + URLS[:5]))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    pages = spark.createDataFrame([(None, URLS[0]), (None, URLS[0]), (1, None), (1, None)], "page_id long, url string")
    assert sum(run(pages).values()) == 4
    assert run(frame(spark, []).limit(0)) == Counter()


def test_tokens_are_in_every_url_that_matches():
    """What a rule is filed under must be a token of each url that its pattern matches."""
    for url in filter(None, URLS):
        held = set(re.findall("[a-z0-9]+", url.lower()))
        for rule in u.PATTERN_RULES:
            if re.search(rule.pattern, url):
                assert held >= set(rule.tokens), (rule.name, url)


@pytest.mark.parametrize("edge", ["5", "s", "x9", "-a", "/"])
def test_longer_endings_hold_the_tokens_too(edge):
    """Nor may a token be only part of a longer one where a pattern ends or begins."""
    for rule in u.PATTERN_RULES:
        for url in filter(None, URLS):
            for start, end in (m.span() for m in re.finditer(rule.pattern, url)):
                for longer in (url[:end] + edge + url[end:], url[:start] + edge + url[start:]):
                    if re.search(rule.pattern, longer):
                        assert set(re.findall("[a-z0-9]+", longer.lower())) >= set(rule.tokens), (rule.name, longer)


def test_a_verdict_does_not_depend_on_other_urls(spark):
    longer = ["http://a.org/login.php5", "http://a.org/wp-login.phps"]
    for others in ([], ["http://a.org/login", "http://b.org/login", "http://c.org/login"], ["http://a.org/x.php", "http://b.org/y.php"]):
        pages = frame(spark, longer + others)
        assert run(pages) == Counter((i, *brute(x)) for i, x in enumerate(longer + others))


def test_rules_are_filed_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("u1", "free"), ("u2", "free"), ("u1", "bets"), ("u3", "spam")], "url string, token string")
    rules = (u.PatternRule("a", "x", ("free", "bets")), u.PatternRule("b", "x", ("spam", "farm")), u.PatternRule("c", "x", ()))
    filed = {r["rule"]: r["token"] for r in u.filed_rules(spark, tokens, rules).collect()}
    assert filed == {"a": "bets", "b": "farm", "c": None}


@pytest.mark.parametrize("rules", [(), u.PATTERN_RULES[:1], tuple(r for r in u.PATTERN_RULES if not r.tokens)])
def test_any_set_of_rules(spark, rules):
    pages = frame(spark, URLS)
    got = {r["url"]: r["pattern_rule"] for r in u.pattern_matches(pages, rules).collect()}
    expected = {}
    for url in filter(None, URLS):
        names = sorted(r.name for r in rules if re.search(r.pattern, url))
        if names:
            expected[url] = names[0]
    assert got == expected


def test_no_python_and_no_product(spark):
    text = u.judge(frame(spark, URLS))._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert word not in text


def test_no_rule_of_ours_is_tried_on_every_url(spark):
    assert all(all(rule.filings()) for rule in u.PATTERN_RULES)
    urls = ["http://a.org/xxx/", "http://a.org/porn/", "http://a.org/link-farm/", "http://a.org/LINKFARM/", "http://a.org/?jsessionid=1",
            "http://a.org/?a=1&PhpSessId=2", "http://a.org/linkfarms/", "http://a.org/porn", "http://link.farm.org/"]
    for url in urls + list(filter(None, URLS)):
        held = set(re.findall("[a-z0-9]+", url.lower()))
        for rule in u.PATTERN_RULES:
            assert not re.search(rule.pattern, url) or any(held >= set(way) for way in rule.filings()), (rule.name, url)
    assert run(frame(spark, urls)) == Counter((i, *brute(x)) for i, x in enumerate(urls))
