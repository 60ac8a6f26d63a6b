import re

from pyspark.sql import functions as F

from medallion.llm.url_filters import DEFAULT_RULES, HOST_RULES, UrlRule, pattern_rule, url_candidates, url_verdicts

URLS = ["http://a.example.net/en/1", "http://example.net/EN/1", "https://x.net/", "https://x.net", "HTTP://M.Example.Com/de/x?y#z",
        "http://example.com/deep/x", "http://notexample.com/de/", "http://a.org/fr/1", "http://a.org/en/1", "no scheme", "", None,
        "http://casino.example.org/x", "http://example.org/casinos", "a://b://c.net/x", "http://net/", "http://anet/", "http://É.net/é",
        "http://h?q/net/", "http://example.net/en", "http://x.org/" + "a/" * 50_000 + "casino", "http://a.ads-track.org/x", "http://bads-track.org/x", "http://x.de/ADS/a/b/banner?x",
        "http://x.de/ads/banners", "http://x.de/ads/1/banner", "http://q.de/torrent/1/magnet/2", "http://track.x.y/1/pixel.gif", "http://track.x.y/pixel.gif/2",
        "http://a-casino.b/bonus/", "http://x.de/a-free-big-download/crack"]


def brute(url, rules):
    u = url or ""
    rest = u.split("://", 1)[1] if "://" in u else ""
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
    hits = [r for r in rules if re.search(r.pattern, host + m[2])] if host + m[2] else []
    best = max(hits, key=lambda r: (r.is_host_rule, len(r.name), r.name), default=None)
    return (host, m[2], best.name if best and best.is_host_rule else None, best.verdict if best else "allow",
            best.name if best else None)


def test_every_rule_on_every_url_gives_the_same(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string")
    free = UrlRule("~digits", "block", r"/[0-9]{1}$", ())
    for rules in (DEFAULT_RULES, (*DEFAULT_RULES, free)):
        rows = url_verdicts(df, rules).collect()
        assert len(rows) == len(URLS) + 1
        for r in rows:
            assert tuple(r)[1:] == brute([*URLS, URLS[0]][r.page_id], rules)
    assert url_verdicts(df.filter("false")).count() == 0


def test_host_rules_hold_the_longest(spark):
    df = spark.createDataFrame([(None, "http://a.example.net/en/1"), (1, "http://a.example.net/de/1")], "page_id long, url string")
    assert {(r.page_id, r.rule, r.verdict) for r in url_verdicts(df, HOST_RULES).collect()} == {
        (None, "example.net/en/", "allow"), (1, "net/", "block")}


def test_rules_beyond_the_broadcast_bound(spark, monkeypatch):
    import medallion.llm.url_filters as m
    monkeypatch.setattr(m, "BROADCAST_RULES", 0)
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    assert {tuple(r) for r in url_verdicts(df).collect()} == {(i, *brute(u, DEFAULT_RULES)) for i, u in enumerate(URLS)}


def test_pattern_tokens_are_those_every_match_holds():
    assert pattern_rule("block", "||ads-track.").tokens == ("ads", "track")
    assert pattern_rule("block", "/popunder/*.js|").tokens == ("popunder", "js")
    assert pattern_rule("block", "/win-*-prize/x").tokens == ("win", "prize")
    assert pattern_rule("block", "ads*track").tokens == ()
    for r in DEFAULT_RULES:
        hits = [u for u in URLS if u and re.search(r.pattern, u.split("://", 1)[-1])]
        assert all(t in re.findall("[a-z0-9]+", u.lower()) for u in hits for t in r.tokens)


def test_the_rarest_token_fetches_the_fewest(spark):
    """Rules of a common and a rare token are fetched by the rare one only."""
    rows = [(k, f"http://www.shop{k}.com/page/{k}") for k in range(400)] + [(900, "http://www.cheap-pills.com/page/1"), (901, "http://x.de/page/rare/2")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = (pattern_rule("block", "/page/*/rare^"), pattern_rule("block", "/page/rare/"), pattern_rule("block", "||www.cheap-pills.com^"))
    fetched = url_candidates(df, rules).collect()
    assert {(r.host, r.name) for r in fetched} == {("x.de", "/page/*/rare^"), ("x.de", "/page/rare/"), ("www.cheap-pills.com", "||www.cheap-pills.com^")}
    common = tuple(UrlRule(r.name, r.verdict, r.pattern, r.tokens[:1]) for r in rules)
    assert url_candidates(df, common).count() > 1000
    assert {r.page_id for r in url_verdicts(df, rules).collect() if r.verdict == "block"} == {900, 901}


def test_no_python_worker(spark):
    from medallion.plans.inspect import physical_plan

    plan = physical_plan(url_verdicts(spark.createDataFrame([(1, "u")], "page_id long, url string").limit(1)))
    assert "Python" not in plan and "MapInArrow" not in plan and "ArrowEval" not in plan
