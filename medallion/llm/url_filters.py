"""URL filter rules found through their rarest literal token.

Each rule is a regular expression over ``host + path`` with the literal tokens
that any match must hold.  The tokens' frequencies over the table's distinct URLs
decide which of them indexes the rule (a pattern of several fixed words by the one that the
fewest URLs hold); a URL's tokens fetch candidate rules by an
equi-join on the token and only candidates run their regular expression.  Rules
without a literal token are tried on every URL.  Of the rules that match a URL the
longest wins (ties: the larger rule text), and a host rule outranks the patterns.

URLs are taken once each however many rows carry them, so a hot URL costs one
row; a hot token reaches no rule that owns a rarer one.  The rule list is broadcast
up to ``BROADCAST_RULES`` and joined by a shuffle beyond.

Null or empty URLs and URLs without ``://`` have empty host and path, match no rule
and are allowed.  Rows that repeat an id keep one result row each, an empty table gives
none, and columns other than id and URL are not read.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import ascii_lower, col

_TOKEN = re.compile(r"[A-Za-z0-9]+")
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class UrlRule:
    """``tokens`` are whole tokens (ASCII letters and digits, lower case) that
    every URL matched by ``pattern`` holds."""
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    is_host_rule: bool = False


def host_rule(verdict: str, host: str, path: str) -> UrlRule:
    """The host and its subdomains, if the path starts with ``path``."""
    at = re.escape(host.lower()) + re.escape(path)
    tokens = _TOKEN.findall(host)
    # the path's last token may go on in the URL, unless a mark ends it
    tokens += [m.group() for m in _TOKEN.finditer(path) if m.end() < len(path)]
    return UrlRule(host.lower() + path, verdict, rf"^(?:[^/]*\.)?{at}", tuple(t.lower() for t in tokens), True)


def word_rule(verdict: str, word: str) -> UrlRule:
    """A word that stands alone between marks, anywhere in host or path."""
    return UrlRule(f"~{word}", verdict, rf"(?i)(?:^|[^A-Za-z0-9]){re.escape(word)}(?:$|[^A-Za-z0-9])", (word.lower(),))


def pattern_rule(verdict: str, text: str) -> UrlRule:
    """A pattern over host and path: ``||`` at its start is the start of a host label, ``|`` at
    its end the end of the path, ``*`` any run of characters and ``^`` a separator (a character
    other than ASCII letters, digits and ``_ - . %``) or the end.  Case does not matter.  Its
    tokens are those that marks of the pattern bound on both sides."""
    anchored, ends = text.startswith("||"), text.endswith("|") and len(text) > 2
    body = text[2 if anchored else 0:len(text) - ends]
    parts = body.split("*")
    made = [re.escape(p).replace(re.escape("^"), "(?:[^A-Za-z0-9_.%-]|$)") for p in parts]
    tokens = []
    for k, part in enumerate(parts):
        for m in _TOKEN.finditer(part):
            left = m.start() > 0 or k == 0 and anchored
            right = m.end() < len(part) or k == len(parts) - 1 and ends
            if left and right:
                tokens.append(m.group().lower())
    pattern = "(?is)" + (r"^(?:[^/]*\.)?" if anchored else "") + ".*".join(made) + ("$" if ends else "")
    return UrlRule(text, verdict, pattern, tuple(tokens))


HOST_RULES = (host_rule("block", "net", "/"), host_rule("allow", "example.net", "/en/"),
              host_rule("block", "example.com", "/de/"), host_rule("allow", "org", "/fr/"))
WORD_RULES = tuple(word_rule("block", w) for w in (
    "adserver", "casino", "doubleclick", "phishing", "popunder", "poker", "porn", "slots", "torrent", "viagra", "warez", "xxx"))
PATTERN_RULES = tuple(pattern_rule("block", t) for t in (
    "||ads-track.", "||cheap-pills.", "||adserver-*.click^", "||track.*/pixel.gif|", "||*-casino.*/bonus/", "||*.top/win-*-prize/", "/ads/*/banner^",
    "/banner/*/click^", "/popunder/*.js|", "/track/*/click^", "/affiliate/*/redirect^", "/sponsored/*/article-", "-free-*-download/crack^",
    "/torrent/*/magnet^", "/wp-login.php/*/xmlrpc.php|", "/slots/*/free-spins^", "/loans/*/no-credit-check^", "/viagra-*/buy-online^",
    "/live-cam/*/private^", "/phish-*/verify-account^"))
DEFAULT_RULES = HOST_RULES + WORD_RULES + PATTERN_RULES


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``; path: then up to ``? #``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    after = F.when(F.contains(u, F.lit("://")), F.substr(u, F.instr(u, "://") + 3)).otherwise("")
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)


_RULE = "rule_no: int, name: string, verdict: string, pattern: string, tokens: array<string>, host_rule: boolean"


def _listed(spark, rules) -> DataFrame:
    """The rules as rows of one literal text: no Python worker, and no more than the list."""
    said = json.dumps([{"rule_no": i, "name": r.name, "verdict": r.verdict, "pattern": r.pattern, "tokens": list(dict.fromkeys(r.tokens)),
                        "host_rule": r.is_host_rule} for i, r in enumerate(rules)])
    return spark.range(1).select(F.inline(F.from_json(F.lit(said), f"array<struct<{_RULE}>>")))


def _index(urls: DataFrame, rules, spark) -> DataFrame:
    """``rules`` with the token that indexes each, null without one."""
    listed = _listed(spark, rules)
    own = listed.select("rule_no", F.explode("tokens").alias("token"))
    counts = (urls.select(F.explode("tokens").alias("token"))
              .join(_small(own.select("token").distinct(), rules), "token", "left_semi").groupBy("token").count())
    rarest = (own.join(counts, "token", "left").groupBy("rule_no")
              .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    return listed.drop("tokens").join(rarest, "rule_no", "left")


def _urls(src: DataFrame) -> DataFrame:
    """Each host and path once, with its tokens."""
    urls = src.select("host", "path").filter("host <> '' or path <> ''").distinct()
    urls = urls.withColumn("at", F.concat("host", "path"))
    return urls.withColumn("tokens", F.array_distinct(F.transform(
        F.regexp_extract_all("at", F.lit("([A-Za-z0-9]+)"), F.lit(1)), F.lower)))


def url_candidates(df: DataFrame, rules: tuple[UrlRule, ...] = DEFAULT_RULES, url_col: str = "url") -> DataFrame:
    """``host``, ``path``, ``name``: the rules with tokens that each URL fetches, which is
    what has to run a regular expression."""
    host, path = host_and_path(col(url_col))
    urls = _urls(df.select(host.alias("host"), path.alias("path")))
    return (urls.select("host", "path", F.explode("tokens").alias("token")).join(_small(_index(urls, rules, df.sparkSession), rules), "token")
            .select("host", "path", "name"))


def _small(df: DataFrame, rules) -> DataFrame:
    return F.broadcast(df) if len(rules) <= BROADCAST_RULES else df


def url_verdicts(df: DataFrame, rules: tuple[UrlRule, ...] = DEFAULT_RULES, id_col: str = "page_id",
                 url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, ``rule`` (the host rule that
    decided), ``verdict`` and ``matched`` (the rule or pattern that decided)."""
    spark = df.sparkSession
    src = df.select(col(id_col).alias("__id"), col(url_col).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    src = src.withColumn("host", host).withColumn("path", path)
    urls = _urls(src)
    index = _index(urls, rules, spark)
    fetched = urls.select("host", "path", "at", F.explode("tokens").alias("token")).join(_small(index, rules), "token")
    if any(not r.tokens for r in rules):
        every = [r for r in rules if not r.tokens]
        fetched = fetched.unionByName(
            urls.select("host", "path", "at", F.lit(None).cast("string").alias("token"), F.explode(F.array(*[
                F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"),
                         F.lit(r.is_host_rule).alias("host_rule")) for r in every])).alias("r"))
            .select("host", "path", "at", "token", F.lit(-1).alias("rule_no"), "r.*"))
    rank = F.struct(F.col("host_rule").cast("int").alias("h"), F.char_length("name").alias("len"))
    best = (fetched.filter(F.regexp_like("at", F.col("pattern")))
            .select("host", "path", rank.alias("rank"), F.struct("name", "verdict", "host_rule").alias("r"))
            .groupBy("host", "path").agg(F.max(F.struct("rank", "r"))["r"].alias("r")))
    best = best.select(F.col("host").alias("__h"), F.col("path").alias("__p"), "r")
    out = src.join(best, (src["host"] == best["__h"]) & (src["path"] == best["__p"]), "left")
    return out.select(F.col("__id").alias(id_col), "host", "path",
                      F.when(F.col("r.host_rule"), F.col("r.name")).alias("rule"),
                      F.coalesce("r.verdict", F.lit("allow")).alias("verdict"), F.col("r.name").alias("matched"))
