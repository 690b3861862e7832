"""URL filters: pattern rules indexed by their rarest literal token.

A rule blocks or allows. Each rule with literal tokens is filed under the one that occurs in the fewest URLs of the table;
the tokens of a URL fetch the rules filed under them, and only these are tried, with their regular expressions. Rules
without a literal token are tried on all URLs.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A token is a run of these characters.
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a Java regular expression on host + path (host in lower case); the longest name wins."""
    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Rule on a host with its subdomains and the beginning of a path."""
    quoted = re.escape(host)
    start = re.escape(path)
    # a path rule may end inside a token, so only tokens closed by a mark are literal
    closed = re.findall(TOKEN + r"(?=[^A-Za-z0-9])", path)
    exact = tuple(t for t in closed if t == t.lower())
    return Rule(host + path, f"^(?:[^/]*\\.)?{quoted}{start}", verdict, (*re.findall(TOKEN, host), *exact))


def word_rule(word: str, verdict: str = "block") -> Rule:
    """Rule on a token, or on a few joined by hyphens, anywhere in host or path (in any case)."""
    return Rule(f"*{word}*", f"(?i)(?:^|[^a-z0-9]){re.escape(word)}(?:$|[^a-z0-9])", verdict,
                tuple(re.findall(TOKEN, word.lower())))


#: Hosts that the method itself rejects: words that name link farms and counterfeit shops.
PATTERNS = (word_rule("spam-farm"), word_rule("cheap-pills"), word_rule("casino"), word_rule("viagra"),
            word_rule("link-farm"), word_rule("free-money"))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[Rule], patterns: tuple[Rule, ...] = PATTERNS) -> DataFrame:
    """page_id, host, path, rule, verdict, reason for each row of ``pages`` (page_id, url; others are ignored).

    ``rules`` decide first and give ``rule``, the longest name winning; else a fitting rule of ``patterns`` gives the verdict
    and ``reason``; else ``allow``. A null or malformed URL fits nothing. The rule lists are written by hand and small.
    """
    spark = pages.sparkSession
    own = [(k, r.name, r.pattern, r.verdict, k < len(rules), list(r.tokens)) for k, r in enumerate((*rules, *patterns))]
    table = spark.createDataFrame(own, "no int, name string, pattern string, decides string, listed boolean, "
                                       "tokens array<string>")
    urls = pages.select(F.col("page_id").cast("long"), "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("tokens", F.array_distinct(F.regexp_extract_all(
        F.lower(F.concat("host", F.lit("/"), "path")), F.lit(f"({TOKEN})"), 1)))
    wanted = F.broadcast(table.select(F.explode("tokens").alias("token")).distinct())
    counts = (urls.select(F.explode("tokens").alias("token")).join(wanted, "token")
              .groupBy("token").agg(F.count("*").alias("urls")))
    filed = (table.select("*", F.explode_outer("tokens").alias("token")).join(counts, "token", "left")
             .groupBy("no", "name", "pattern", "decides", "listed")
             .agg(F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("token")))
    lookup = filed.where("token is not null").groupBy("token").agg(
        F.collect_list(F.struct("listed", "name", "pattern", "decides")).alias("rules"))
    # the index has one entry per token of the written rules: collected and carried as a constant map
    index = {r.token: [tuple(x) for x in r.rules] for r in lookup.collect()}
    always = [(r[4], r[1], r[2], r[3]) for r in own if not r[5]]
    kind = "array<struct<listed: boolean, name: string, pattern: string, decides: string>>"
    entry = ("listed", "name", "pattern", "decides")
    constant = json.dumps({"filed": {t: [dict(zip(entry, r)) for r in v] for t, v in index.items()},
                           "always": [dict(zip(entry, r)) for r in always]})
    found = urls.withColumn("rules", F.from_json(F.lit(constant), f"filed map<string, {kind}>, always {kind}")).select(
        "page_id", "host", "path", "tokens", "rules.filed", "rules.always")
    candidates = F.concat(F.col("always"), F.flatten(F.transform(
        F.filter("tokens", lambda t: F.map_contains_key("filed", t)), lambda t: F.col("filed")[t])))
    text = F.concat("host", "path")
    fitting = F.filter(candidates, lambda r: F.regexp(text, r["pattern"]))
    ranked = F.sort_array(F.transform(fitting, lambda r: F.struct(
        r["listed"].alias("listed"), F.length(r["name"]).alias("size"), r["name"].alias("name"),
        r["decides"].alias("decides"))), asc=False)
    best = F.get(F.col("ranked"), F.lit(0))
    return found.select("page_id", "host", "path", ranked.alias("ranked")).select(
        "page_id", "host", "path", F.when(best["listed"], best["name"]).alias("rule"),
        F.coalesce(best["decides"], F.lit("allow")).alias("verdict"),
        F.when(~best["listed"], best["name"]).alias("reason"))
