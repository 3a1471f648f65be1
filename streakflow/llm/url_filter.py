"""URL filter: pattern rules indexed by their rarest literal token.

A rule's pattern has ``||`` in front (the host or any parent of it starts here), ``^``
(a separator: anything but an ASCII letter or digit, or an end), ``*`` (anything) and
literal characters. It is matched against host + path as a regular expression.

An URL is cut into tokens, its runs of ASCII letters and digits. A literal token of a
pattern that is closed on both sides must be a whole token of every URL it matches, so
each rule is filed under one such token only: the one that the fewest URLs have, as
counted over the whole table. An URL's tokens fetch candidate rules, and only those
run their regular expressions. Rules without a closed token are candidates for every
URL. Everything is computed once per distinct URL.

All steps are DataFrame expressions and equi-joins; no Python runs on executors.

Cases: a null URL, or one without ``://``, has empty host and path and fits no rule
with a host; repeated rows get the same verdict; of equally long rules the smaller
name wins; other columns are not read unless carried; an empty rule list leaves the
default verdict.
"""
from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_SEPARATOR = r"(?:\A|\z|[^A-Za-z0-9])"
#: Rules up to this many are broadcast to the URL tokens; a longer list is joined by shuffle.
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    """``rank`` decides first, then the length of the pattern's literal text."""

    name: str
    pattern: str
    verdict: str
    rank: int = 0


def prefix_rule(where: str, verdict: str) -> Rule:
    """``where`` is host + path prefix; it fits the host and its subdomains."""
    return Rule(where, "||" + where, verdict, rank=1)


def _elements(pattern: str) -> list[str]:
    return re.findall(r"^\|\||[A-Za-z0-9]+|.", pattern, re.DOTALL)


def pattern_regex(pattern: str) -> str:
    special = {"||": r"\A(?:[^/]*\.)?", "^": _SEPARATOR, "*": r"[\s\S]*"}
    return "".join(special.get(e) or (e if e.isalnum() and e.isascii() else "\\x{%x}" % ord(e)) for e in _elements(pattern))


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every URL fitting the pattern has whole."""
    elements = ["*", *_elements(pattern), "*"]
    return sorted({e for before, e, after in zip(elements, elements[1:], elements[2:])
                   if re.fullmatch("[A-Za-z0-9]+", e) and before != "*" and after != "*"})


def host_and_path(url: str) -> tuple[Column, Column]:
    rest = F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def _rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [F.struct(F.lit(r.name).alias("name"), F.lit(pattern_regex(r.pattern)).alias("regex"),
                     F.lit(r.verdict).alias("verdict"), F.lit(r.rank).alias("rank"),
                     F.lit(len(re.sub(r"\|\||[*^]", "", r.pattern))).alias("length"),
                     F.array(*map(F.lit, literal_tokens(r.pattern) or [""])).alias("tokens")) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", carry: tuple[str, ...] = ("page_id",),
               default: str = "allow") -> DataFrame:
    """``carry`` columns plus host, path, rule (name of the winning rule or null),
    rule_rank and verdict."""
    host, path = host_and_path(url_col)
    rows = pages.select(*carry, F.col(url_col).alias("__url"), host.alias("host"), path.alias("path"))
    if not rules:
        return rows.select(*carry, "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(None).cast("int").alias("rule_rank"), F.lit(default).alias("verdict"))
    target = F.concat("host", "path")
    own = F.array_remove(F.array_distinct(F.split("target", "[^A-Za-z0-9]+")), "")
    everywhere = any(not literal_tokens(r.pattern) for r in rules)
    tokens = (rows.select("__url", target.alias("target")).where("target <> ''").distinct()
              .select("__url", "target", F.explode(F.concat(own, F.array(F.lit(""))) if everywhere else own).alias("token")))
    table = _rule_table(pages.sparkSession, rules)
    filed = table.withColumn("token", F.explode("tokens")).drop("tokens")
    size = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    counts = tokens.join(size(filed.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    index = (filed.join(counts, "token", "left")
             .groupBy("name", "regex", "verdict", "rank", "length")
             .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    fits = tokens.join(size(index), "token").where(F.expr("target rlike regex"))
    order = F.struct("rank", "length", F.struct("name", "verdict").alias("is"))
    best = fits.groupBy("__url").agg(F.max(F.struct("rank", "length")).alias("top"), F.collect_set(order).alias("all"))
    # the rules that fit one URL are no more than the rule list
    win = F.array_min(F.transform(F.filter("all", lambda x: (x["rank"] == F.col("top.rank")) & (x["length"] == F.col("top.length"))),
                                  lambda x: x["is"]))
    best = best.select("__url", F.col("top.rank").alias("rule_rank"), win.alias("win"))
    return rows.join(best, "__url", "left").select(
        *carry, "host", "path", F.col("win.name").alias("rule"), "rule_rank",
        F.coalesce("win.verdict", F.lit(default)).alias("verdict"))


#: The site list of the contract (fixed values).
SITE_RULES = [prefix_rule("org/", "allow"), prefix_rule("example.org/es/", "block"), prefix_rule("example.org/en/1", "block"),
              prefix_rule("com/fr/", "allow"), prefix_rule("com/de/", "block")]
#: What the method itself blocks: host or path words of spam and adult sites.
PATTERN_RULES = [Rule(word, f"^{word}^", "block") for word in
                 ("adult", "casino", "pills", "porn", "viagra", "xxx")]
