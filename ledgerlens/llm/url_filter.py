"""URL filters by an index of rare tokens (operator 3, native).

A rule is a regular expression over a url's subject (host, then path) with an
action.  Each rule is indexed under one literal token that every match must
contain: of its literal tokens, the one that fewest of the table's urls hold.
A url's tokens fetch the rules indexed under them, and only those run their
regular expression.  Rules without a literal token are candidates of every
url.  Of the rules that match, a host rule goes before a pattern, then the
longest name wins, then the name itself decides.

Tokens are the maximal runs of ASCII letters and digits, A-Z lower-cased.  A
literal counts as a rule's token only where the rule itself delimits it on
both sides, so a match always contains it as a whole token.

All work is on the distinct urls: a url on a third of all pages is one row.
The rules are a table of their own, given as one for long lists; Spark broadcasts
it if its size allows and joins by token otherwise.  Only rules without a token
(``MAX_TOKENLESS`` at most) become literals of the plan.  The verdicts go back to the pages by a join on the url,
whose hot keys AQE splits.

Defined results: a null url, or one without ``://``, has an empty host and
path; nothing matches it and it is allowed, as is every url that no rule
matches.  Repeated rows and null page ids each keep their row; an empty table
gives an empty result; with no rules every url is allowed.  Other columns are
ignored; a very long url is matched whole.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import text_of

TOKEN = "[a-z0-9]+"
MAX_TOKENLESS = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    name: str  # what the result shows for a host rule
    action: str  # allow or block
    regex: str  # over host + path, the host's A-Z lower-cased
    tokens: tuple[str, ...]  # literal tokens that every match contains
    is_host: bool


def host_rule(action: str, name: str) -> Rule:
    """``host/path``: the host and all its subdomains, paths that start so."""
    host, _, path = name.partition("/")
    path = "/" + path
    # The host's labels and the path's parts up to its last delimiter are whole
    # tokens of every match; a part at the rule's end may go on in the url.
    safe = f"{host}{re.sub('[A-Za-z0-9]+$', '', path)}".lower()
    return Rule(name, action, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(dict.fromkeys(re.findall(TOKEN, safe))), True)


def pattern_rule(action: str, name: str, regex: str, *tokens: str) -> Rule:
    """A regular expression with the literal tokens that it implies."""
    return Rule(name, action, regex, tokens, False)


# Fixed values of the query's contract.
HOST_RULES = (
    host_rule("allow", "com/"),
    host_rule("block", "example.com/en/"),
    host_rule("allow", "www.example.com/en/"),
    host_rule("block", "net/es/"),
    host_rule("block", "net/fr/"),
)
# What a crawl leaves out where no host rule decides.
PATTERNS = (
    pattern_rule("block", "ad host", r"^(?:[^/]*[.-])?ads[.-]", "ads"),
    pattern_rule("block", "tracker host", r"^(?:[^/]*[.-])?track[.-]", "track"),
    pattern_rule("block", "sign-in page", r"^[^/]+/(?:[^/]+/)*login(?:[/.]|$)", "login"),
    pattern_rule("block", "cart page", r"^[^/]+/(?:[^/]+/)*cart(?:[/.]|$)", "cart"),
    pattern_rule("block", "archive file", r"^[^/]+/.*\.zip$", "zip"),
    pattern_rule("block", "program file", r"^[^/]+/.*\.exe$", "exe"),
)


def _part(url: Column, part: int) -> Column:
    return F.regexp_extract(text_of(url), r"(?s)^.*?://([^/?#]*)([^?#]*)", part)


def host(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return _part(url, 2)


def rule_array(rules: tuple[Rule, ...]) -> Column:
    """The rules as a literal array, made on the JVM side."""
    schema = "array<struct<name:string,action:string,regex:string,tokens:array<string>,is_host:boolean>>"
    rows = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("name"), F.lit(r.action).alias("action"), F.lit(r.regex).alias("regex"),
                F.array(*map(F.lit, r.tokens)).cast("array<string>").alias("tokens"), F.lit(r.is_host).alias("is_host"),
            )
            for r in rules
        )
    )
    return rows.cast(schema)


def rule_table(spark: SparkSession, rules: tuple[Rule, ...] | DataFrame) -> tuple[DataFrame, Column]:
    """The rules with a token as a table, one row per rule and token, and the
    others as a literal array."""
    columns = ("name", "action", "regex", "is_host")
    if not isinstance(rules, DataFrame):
        table = spark.range(1).select(F.inline(rule_array(tuple(r for r in rules if r.tokens))))
        return table.select(*columns, F.explode("tokens").alias("token")), rule_array(tuple(r for r in rules if not r.tokens))
    free = rules.where("tokens IS NULL OR size(tokens) = 0").select(*columns).limit(MAX_TOKENLESS + 1).collect()
    if len(free) > MAX_TOKENLESS:
        raise ValueError(f"more than {MAX_TOKENLESS} rules without a literal token would each meet every url")
    return rules.select(*columns, F.explode("tokens").alias("token")), rule_array(tuple(Rule(r.name, r.action, r.regex, (), r.is_host) for r in free))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = HOST_RULES + PATTERNS, url: str = "url", id_col: str = "page_id") -> DataFrame:
    """One row per row of ``pages``: the id, host, path, rule (of a host rule,
    else null), verdict, and pattern (the name of the pattern that decided).
    ``rules`` may be a DataFrame of a rule's fields (name, action, regex, tokens
    array, is_host)."""
    urls = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct()
    urls = urls.select("url", F.concat(host(F.col("url")), path(F.col("url"))).alias("subject"))
    tokens = F.array_distinct(F.regexp_extract_all(F.translate("subject", UPPER, LOWER), F.lit(TOKEN), 0))
    held = urls.select("url", "subject", F.explode(tokens).alias("token"))

    literal, free = rule_table(pages.sparkSession, rules)
    wanted = literal.select("token").distinct()
    counts = held.join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    # A token that no url holds is the rarest of all.
    rarest = F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))["token"]
    index = literal.join(counts, "token", "left").groupBy("name", "action", "regex", "is_host").agg(rarest.alias("token"))

    fetched = held.join(index, "token").select("url", "subject", "name", "action", "regex", "is_host")
    always = urls.select("url", "subject", F.inline(free)).drop("tokens")
    candidates = fetched.union(always)
    matched = candidates.where(F.expr("rlike(subject, regex)"))
    best = F.max(F.struct("is_host", F.length("name").alias("length"), "name", "action"))
    verdicts = matched.groupBy(F.col("url").alias("judged")).agg(best.alias("best"))

    rows = pages.select(F.col(id_col).alias(id_col), F.col(url).alias("url")).join(verdicts, F.col("url") == F.col("judged"), "left")
    return rows.select(
        id_col,
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        F.when(F.col("best.is_host"), F.col("best.name")).alias("rule"),
        F.coalesce("best.action", F.lit("allow")).alias("verdict"),
        F.when(~F.col("best.is_host"), F.col("best.name")).alias("pattern"),
    )
