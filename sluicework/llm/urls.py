"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal words (tokens) that any URL it fits must hold. Each rule is filed under
the one of its tokens that is rarest among the URLs; a URL fetches the rules filed under its own tokens, and only these
run. DataFrame functions only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rules are broadcast while their text is shorter than this, else both sides are shuffled by token.
BROADCAST_CHARS = 4_000_000
TOKEN = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in the URL without its scheme, host in lower case. Rules of a higher ``tier`` win over
    others; within a tier the longest ``name`` wins, then block over allow, then the smaller name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    tier: int = 0


def _tokens(literal: str) -> tuple[str, ...]:
    return tuple(sorted({t for t in re.split(TOKEN, literal.lower()) if t}))


def host_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """Fits a host and all its subdomains where the path starts with ``path``. Only words of the path that end within
    it are tokens: the last one may go on in a URL."""
    whole = path[: path.rfind("/") + 1] if re.search("[A-Za-z0-9]$", path) else path
    pattern = rf"^(?:[^/?#]*\.)?{re.escape(host.lower())}(?=[/?#]|$){re.escape(path)}"
    return Rule(host.lower() + path, verdict, pattern, tuple(sorted({*_tokens(host), *_tokens(whole)})), 1)


def word_rule(verdict: str, *words: str) -> Rule:
    """Fits a URL that holds these words in a row, with anything but letters and digits between and around them."""
    middle = "[^A-Za-z0-9]+".join(re.escape(w) for w in words)
    return Rule("-".join(words), verdict, rf"(?i)(?:^|[^a-z0-9]){middle}(?:[^a-z0-9]|$)", tuple(sorted({w.lower() for w in words})))


# Rules of the method for URLs that no host rule fits; the default of a parameter.
SPAM_RULES = (
    word_rule("block", "cheap", "pills"),
    word_rule("block", "free", "casino"),
    word_rule("block", "online", "casino"),
    word_rule("block", "payday", "loans"),
    word_rule("block", "adult", "dating"),
    word_rule("block", "replica", "watches"),
    word_rule("block", "xxx"),
    word_rule("block", "torrent", "download"),
    word_rule("allow", "wiki"),
)


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case; empty without ``://``."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    def row(r: Rule) -> Column:
        tokens = F.array(*map(F.lit, r.tokens)).cast("array<string>")
        return F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"),
            tokens.alias("tokens"), F.lit(r.tier).alias("tier"),
        )

    if not rules:
        return _rule_table(spark, (Rule("", "allow", "", ()),)).filter("tier < 0")
    return spark.range(1).select(F.inline(F.array(*map(row, rules))))


def _words(target: Column) -> Column:
    """The tokens of a URL, each once; the empty one files rules without a token."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.array_remove(F.split(_ascii_lower(target), TOKEN), "")))


def index(rules: DataFrame, targets: DataFrame) -> DataFrame:
    """Each rule with its rarest token, by the number of distinct ``targets`` that hold it; ties by the token itself.

    Only tokens of rules are counted, and counts are combined before the shuffle.
    """
    wanted = rules.select("rule", "tier", F.explode_outer("tokens").alias("token"))
    names = F.broadcast(wanted.select("token").filter("token IS NOT NULL").distinct())
    held = targets.select(F.explode(_words(F.col("target"))).alias("token")).join(names, "token", "left_semi")
    counts = wanted.join(held.groupBy("token").count(), "token", "left")
    rarest = F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token"))
    filed = counts.groupBy("rule", "tier").agg(F.coalesce(rarest, F.lit("")).alias("token"))
    return rules.join(filed, ["rule", "tier"]).drop("tokens")


def judge(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``(url, host, path, rule, tier, verdict)`` for each distinct non-null URL; rule null and verdict ``allow``
    where no rule fits."""
    spark = urls.sparkSession
    distinct = urls.select(F.col(url).alias("url")).filter("url IS NOT NULL").distinct()
    parts = distinct.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    # A URL without a scheme has no host, and no host rule fits it; its text is still searched for words.
    after = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*(.*)$", 1)
    target = F.when(F.col("url").contains("://"), F.concat("host", after)).otherwise(F.concat(F.lit("/"), "url"))
    parts = parts.withColumn("target", target)
    filed = index(_rule_table(spark, rules), parts.select("target"))
    if sum(len(r.name) + len(r.pattern) for r in rules) <= BROADCAST_CHARS:
        filed = F.broadcast(filed)
    fetched = parts.select("url", "target", F.explode(_words(F.col("target"))).alias("token")).join(filed, "token")
    fits = fetched.filter(F.expr("target RLIKE pattern"))
    rank = F.struct("tier", F.length("rule"), (F.col("verdict") == "block"), F.col("rule"))
    best = fits.groupBy("url").agg(F.max_by(F.struct("rule", "tier", "verdict"), rank).alias("best"))
    joined = parts.join(best, "url", "left")
    return joined.select("url", "host", "path", "best.rule", "best.tier", F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", key: str = "page_id") -> DataFrame:
    """``(page_id, url, host, path, rule, tier, verdict)`` for every row of ``pages``.

    Each distinct URL is judged once and the verdict joined back, so a URL that many rows share costs no more than
    another, and adaptive execution can split the join at it. A null URL, and one that no rule fits, has no rule and is
    allowed; host and path are empty for a null URL and for one without ``://``. Repeated rows come out as often as
    they come in. Other columns are ignored.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    joined = rows.join(judge(rows, rules, "url"), "url", "left")
    empty = F.lit("")
    return joined.select(
        "page_id", "url", F.coalesce("host", empty).alias("host"), F.coalesce("path", empty).alias("path"),
        "rule", "tier", F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )


def sql_twin(rules: Sequence[Rule], table: str = "pages") -> str:
    """DuckDB text of ``filter_urls``: every rule on every URL."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    rows = ", ".join(f"({quoted(r.name)}, {quoted(r.verdict)}, {quoted(r.pattern.replace('(?=[/?#]|$)', ''))}, {r.tier})" for r in rules)
    return f"""
WITH rules(rule, verdict, pattern, tier) AS (VALUES {rows}),
parts AS (SELECT DISTINCT url,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{ascii_uppercase}', '{ascii_lowercase}') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '(?s)^.*?://[^/?#]*(.*)$', 1) AS rest FROM {table} WHERE url IS NOT NULL),
targets AS (SELECT *, CASE WHEN contains(url, '://') THEN host || rest ELSE '/' || url END AS target FROM parts),
ranked AS (SELECT url, rule, verdict, tier, row_number() OVER (PARTITION BY url
    ORDER BY tier DESC, length(rule) DESC, (verdict = 'block') DESC, rule DESC) AS n
    FROM targets JOIN rules ON regexp_matches(target, pattern)),
best AS (SELECT * FROM ranked WHERE n = 1)
SELECT p.page_id, coalesce(t.host, '') AS host, coalesce(t.path, '') AS path,
    CASE WHEN b.tier = 1 THEN b.rule END AS rule, coalesce(b.verdict, 'allow') AS verdict
FROM {table} p LEFT JOIN targets t ON t.url = p.url LEFT JOIN best b ON b.url = p.url"""
