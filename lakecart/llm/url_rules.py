"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path`` of a URL:

    ||      start of the host or of one of its subdomain labels (only at the start)
    *       any run of characters
    ^       a separator (anything but a letter, digit, ``-``, ``.``, ``%``, ``_``) or the end
    other   itself (hosts are lower-cased, paths keep their case)

Index: the literal tokens of a pattern are its runs of ASCII letters and
digits with a literal non-token character, ``^`` or ``||`` on both sides, so
any URL that fits the rule has them as whole tokens.  Every rule is filed
under the token that is rarest among the URLs of the table at hand (counted
over all of them).  A URL's tokens fetch candidate rules by an equality join,
and only those candidates run their regular expression.  Rules without such a
token are filed under the empty token, which every URL has.

Of the rules that fit a URL the longest pattern decides (ties: the smallest).
Rules are grouped in two lists: ``prefix`` rules (host and path prefix, as
``net/``) decide first; of the others the longest decides where no prefix rule
fits; a URL that no rule fits is allowed.

Every distinct URL is judged once, so a URL that makes up a third of the table
costs one row.  The rule index is broadcast only if its counted rows are
within ``BROADCAST_RULES``; beyond that the same join shuffles by token.

Defined results: null URL or no ``://`` -> empty host and path, no rule,
``allow`` (unless a pattern fits the empty text); extra columns are left
aside; repeated pages give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.llm.storage import broadcast_if_small, materialize

#: Rules that decide before all others: (verdict, host and path prefix).
PREFIX_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Pattern rules of the method's own list.
PATTERN_RULES = (
    ("block", "||casino*"), ("block", "casino-win."), ("block", ".casino."), ("block", "-casino."),
    ("block", "/casino/"), ("block", "||bet365^"), ("block", "/poker/"), ("block", "-poker."),
    ("block", "xxx."), ("block", "/porn/"), ("block", "||porn*"), ("block", "-sex."), ("block", "/warez/"),
    ("block", "/viagra/"), ("block", "-pills."), ("block", "/ads/*.js"), ("block", "/wp-login.php^"),
    ("block", "||tracker."), ("block", "||adserver."), ("block", "/cgi-bin/*.exe^"),
    ("allow", "/privacy/"), ("allow", "||docs."),
)
BROADCAST_RULES = 500_000
_TOKEN = re.compile(r"[A-Za-z0-9]+")


def regex_of(pattern: str) -> str:
    """The regular expression (Java and RE2) of a pattern, for ``host + path``."""
    anchored = pattern.startswith("||")
    body = pattern[2:] if anchored else pattern
    out = "".join(".*" if c == "*" else r"(?:[^A-Za-z0-9._%-]|$)" if c == "^" else re.escape(c) if c.isascii() else c
                  for c in body)
    # Anchored: the match starts the host or follows a dot of it (no slash before).
    return ("^(?:[^/]*\\.)?" if anchored else "") + out


def prefix_regex(rule: str) -> str:
    """``host/path``: the host or a subdomain of it, and a path that starts so."""
    host, slash, path = rule.partition("/")
    return "^(?:[^/]*\\.)?" + re.escape(host) + "(?:" + re.escape(slash + path) + ")"


def literal_tokens(pattern: str) -> list[str]:
    """Lower-cased tokens that every URL fitting the pattern has as whole tokens."""
    body = pattern[2:] if pattern.startswith("||") else pattern
    out = []
    for m in _TOKEN.finditer(body):
        before = body[m.start() - 1] if m.start() else ("|" if pattern.startswith("||") else "*")
        after = body[m.end()] if m.end() < len(body) else "*"
        if before != "*" and after != "*":
            out.append(m[0].lower())
    return sorted(set(out))


def rule_table(spark: SparkSession, prefix=PREFIX_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """(list, rule, verdict, regex, tokens) of both lists; a longer list can be given as a table of the same form."""
    rows = [("prefix", r, v, prefix_regex(r), literal_tokens("||" + r)) for v, r in prefix]
    rows += [("pattern", r, v, regex_of(r), literal_tokens(r)) for v, r in patterns]
    return spark.createDataFrame(rows, "list string, rule string, verdict string, regex string, tokens array<string>")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    # The first group of (?s)://... is everything after the first "://".
    after = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the pattern that decided (``pattern``)."""
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    urls = materialize(rows.select("host", "path").distinct().withColumn("tokens", F.array_distinct(F.filter(
        F.split(F.lower(F.concat("host", "path")), "[^a-z0-9]+"), lambda t: t != ""))), "urls")
    words = urls.select("host", "path", F.explode("tokens").alias("token"))
    listed = materialize(rules.select("list", "rule", "verdict", "regex", F.explode_outer("tokens").alias("token")), "rule-tokens")
    # How often each rule token occurs among the distinct URLs.
    seen = (words.join(listed.select("token").distinct(), "token", "left_semi")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rarest = F.min_by(F.coalesce("token", F.lit("")), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))
    index = materialize(listed.join(seen, "token", "left").groupBy("list", "rule", "verdict", "regex")
                        .agg(rarest.alias("token")), "rule-index")
    side = broadcast_if_small(index, BROADCAST_RULES)
    fetch = words.unionByName(urls.select("host", "path", F.lit("").alias("token")))
    fits = fetch.join(side, "token").filter(F.expr("concat(host, path) rlike regex"))

    def longest(kind: str) -> Column:
        # Longest first, then the smallest rule; max() keeps the struct whole.
        best = F.max(F.when(F.col("list") == kind, F.struct(F.length("rule").alias("l"), F.col("rule"), F.col("verdict"))))
        return best

    found = fits.groupBy("host", "path").agg(longest("prefix").alias("p"), longest("pattern").alias("m"))
    return (rows.join(found.select(F.col("host").alias("h"), F.col("path").alias("q"), "p", "m"),
                      (F.col("host") == F.col("h")) & (F.col("path") == F.col("q")), "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("p.rule").alias("rule"),
                    F.coalesce("p.verdict", "m.verdict", F.lit("allow")).alias("verdict"),
                    F.when(F.col("p").isNull(), F.col("m.rule")).alias("pattern")))
