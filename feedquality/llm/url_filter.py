"""URL filter: pattern rules, found by their rarest literal token.

A rule is a regular expression with the literal tokens that any url it matches must hold.
Each rule is filed under that one of its tokens which the urls at hand hold least often; one
whose matches hold one of several sets of tokens is filed once for each set. A rule without
literal tokens is filed under none and tried on every url. The tokens of a
url fetch the rules filed under them, and only those expressions are run.

Before that, host and path rules allow or block by the longest that fits. Where none fits,
a url is blocked if a pattern rule matches and allowed otherwise.

All of it is DataFrame expressions. Urls are judged once each, however often they occur,
and their tokens are joined to the few filed rules, so nothing of a page but its url moves
and no group is gathered. Null urls and urls without ``://`` have an empty host and path;
a null url matches no rule and is allowed. Repeated rows are judged alike; clashing extra
columns are not looked at; an empty table gives an empty result, and no rules allow all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedquality.llm.text import read
from feedquality.session import stage

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class PathRule:
    """Holds for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class PatternRule:
    """Blocks urls that ``pattern`` matches, which must hold all of ``tokens`` (small letters and digits),
    and all of one of the sets in ``ways`` if there are any."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    ways: tuple[tuple[str, ...], ...] = ()

    def filings(self) -> list[tuple[str, ...]]:
        return [self.tokens + way for way in self.ways or ((),)]


# The base rules.
PATH_RULES = (
    PathRule("allow", "com", "/"), PathRule("block", "example.com", "/en/"),
    PathRule("allow", "www.example.com", "/en/"), PathRule("block", "net", "/es/"), PathRule("block", "net", "/fr/"),
)

#: What the method blocks: sellers, betting, adult pages, link farms, and pages that are copies of others.
PATTERN_RULES = (
    PatternRule("pills", r"(?i)://([a-z0-9.-]*[.-])?cheap-pills[.-]", ("cheap", "pills")),
    PatternRule("pharmacy", r"(?i)[./-](online-)?pharmacy[./-]", ("pharmacy",)),
    PatternRule("bets", r"(?i)://([a-z0-9.-]*[.-])?free-bets[.-]", ("free", "bets")),
    PatternRule("casino", r"(?i)[./-]casino[./-]", ("casino",)),
    PatternRule("adult", r"(?i)://([a-z0-9.-]*[.-])?adult-[a-z0-9]+[.]", ("adult",)),
    PatternRule("porn", r"(?i)[./-](porn|xxx)[./-]", (), (("porn",), ("xxx",))),
    PatternRule("farm", r"(?i)://([a-z0-9.-]*[.-])?spam-farm[.-]", ("spam", "farm")),
    PatternRule("links", r"(?i)[./-]link-?farm[./-]", (), (("link", "farm"), ("linkfarm",))),
    PatternRule("tracked", r"(?i)[?&]utm_source=[^&#]*&.*utm_campaign=", ("utm", "source", "campaign")),
    PatternRule("login", r"(?i)/(wp-)?login[.]php", ("login",)),  # php5 and phps match too
    PatternRule("printing", r"(?i)[?&]print=(1|true|yes)(&|#|$)", ("print",)),
    PatternRule("session", r"(?i)[?&](phpsessid|jsessionid)=", (), (("phpsessid",), ("jsessionid",))),
)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to a slash, question mark or hash, A-Z small."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def path_rule(host: Column, path: Column, rules: tuple[PathRule, ...] = PATH_RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.host + rule.path).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column) -> Column:
    """The distinct runs of letters and digits of a url, A-Z small."""
    return F.array_distinct(F.filter(F.split(F.translate(url, CAPITALS, SMALL), "[^a-z0-9]+"), lambda t: t != ""))


def filed_rules(spark: SparkSession, tokens: DataFrame, rules: tuple[PatternRule, ...]) -> DataFrame:
    """Each rule with the token it is filed under, for each way: that of its tokens which the fewest urls hold."""
    table = spark.createDataFrame([(r.name, r.pattern, i, list(way)) for r in rules for i, way in enumerate(r.filings())],
                                  "rule string, pattern string, way int, tokens array<string>")
    wanted = table.select("rule", "pattern", "way", F.explode_outer("tokens").alias("token"))
    held = tokens.join(F.broadcast(wanted.select("token").distinct()), "token").groupBy("token").agg(
        F.count(F.lit(1)).alias("urls"))  # a row for each token of a rule at most
    rarest = F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))
    return (wanted.join(held, "token", "left").groupBy("rule", "pattern", "way").agg(rarest.alias("r"))
            .select("rule", "pattern", F.col("r.token").alias("token")))


def pattern_matches(urls: DataFrame, rules: tuple[PatternRule, ...] = PATTERN_RULES) -> DataFrame:
    """``url`` and the first matching ``pattern_rule`` (by name), for each distinct url that one matches."""
    spark = urls.sparkSession
    distinct = stage(urls.filter("url is not null").select("url").distinct(), "urls")
    tokens = distinct.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    filed = stage(filed_rules(spark, tokens, rules), "filed")  # one row for each way of a rule
    fetched = tokens.join(F.broadcast(filed), "token").select("url", "rule", "pattern")
    everywhere = [r for r in rules if not all(r.filings())]
    tried = fetched.filter(F.expr("regexp_like(url, pattern)")).select("url", "rule")
    for rule in everywhere:
        tried = tried.unionByName(distinct.filter(F.col("url").rlike(rule.pattern)).select("url", F.lit(rule.name).alias("rule")))
    return tried.groupBy("url").agg(F.min("rule").alias("pattern_rule"))


def judge(pages: DataFrame, path_rules: tuple[PathRule, ...] = PATH_RULES,
          pattern_rules: tuple[PatternRule, ...] = PATTERN_RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, the path rule, the pattern rule and the verdict of every page."""
    pages = pages.select("page_id", "url")
    matches = pattern_matches(pages, pattern_rules)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.join(matches, "url", "left").withColumns({"host": host, "path": path})
    name, verdict = path_rule(F.col("host"), F.col("path"), path_rules)
    method = F.when(F.col("pattern_rule").isNotNull(), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", name.alias("rule"), "pattern_rule",
                         F.coalesce(verdict, method).alias("verdict"))


def op4_url_filter(spark, sf):
    return judge(read(spark, sf, "pages")).select("page_id", "host", "path", "rule", "verdict", "pattern_rule")


def _sql_rule(rule: PathRule) -> str:
    return (f"when (host = '{rule.host}' or host like '%.{rule.host}') and starts_with(path, '{rule.path}')"
            f" then '{rule.host}{rule.path}'")


OP4_SQL = rf"""
with parts as (
  select page_id, url,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), '{CAPITALS}', '{SMALL}') as host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
ruled as (
  select *, case {' '.join(map(_sql_rule, sorted(PATH_RULES, key=lambda r: -len(r.host + r.path))))} end as rule
  from parts),
patterns(name, pattern) as (values {', '.join(f"('{r.name}', '{r.pattern}')" for r in PATTERN_RULES)}),
matched as (
  select url, min(name) as pattern_rule
  from (select distinct url from pages where url is not null), patterns where regexp_matches(url, pattern) group by url)
select page_id, host, path, rule, pattern_rule,
       coalesce(case {' '.join(f"when rule = '{r.host}{r.path}' then '{r.verdict}'" for r in PATH_RULES)} end,
                case when pattern_rule is not null then 'block' else 'allow' end) as verdict
from ruled left join matched using (url)
"""
