"""URL filters: pattern rules found through their rarest literal token.

A pattern is literal text with three wildcards: ``||`` at the start stands for the host or any of its parent domains,
``*`` for any characters (within the host as long as the pattern is), ``^`` for a separator (no letter or digit) or an end. It runs against host followed by path.
A literal token is a run of ASCII letters and digits that the pattern bounds on both sides, so a URL that fits holds it
as a whole token. Each rule is filed under the one of its tokens that fewest URLs hold; the tokens of a URL fetch
candidate rules by an equi-join, and only those run their regular expression. Rules without such a token are rejected
when they are read.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``,
``#`` or the end. A null URL or one without ``://`` has empty host and path and meets no rule. Listed prefix rules go
before patterns, longer ones before shorter ones; of patterns the longest decides, block before allow. URLs that no rule
fits are allowed. Repeated rows, null ids and an empty table are fine; every input row gives one output row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import ASCII_UPPER, lower_ascii

#: More rules than this are joined without a broadcast hint.
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class UrlRule:
    """``listed`` rules are prefixes whose text is reported and that go before patterns."""

    pattern: str
    verdict: str
    listed: bool = False


def prefix_rule(verdict: str, rule: str) -> UrlRule:
    return UrlRule("||" + rule, verdict, listed=True)


# The rules that the URL query must apply.
LISTED_RULES = (
    prefix_rule("allow", "org/"),
    prefix_rule("block", "example.org/es/"),
    prefix_rule("block", "example.org/en/1"),
    prefix_rule("allow", "com/fr/"),
    prefix_rule("block", "com/de/"),
)

#: Words that name unwanted sites when they stand alone in a host name.
UNWANTED_HOST_WORDS = "adult ads adserver bet bets bingo casino escort gambling jackpot payday pharmacy pills poker porn sex slots spam tracker tracking viagra warez xxx".split()
PATTERN_RULES = tuple(UrlRule(start + w + "^", "block") for w in UNWANTED_HOST_WORDS for start in ("||", "||*^"))


def literal_tokens(pattern: str) -> list[str]:
    """Lower-case letter-and-digit runs that the pattern bounds on both sides."""
    anchored = pattern.startswith("||")
    body = pattern[2:] if anchored else pattern
    tokens = []
    for m in re.finditer(r"[A-Za-z0-9]+", body):
        before = body[m.start() - 1] if m.start() else ("." if anchored else "*")
        after = body[m.end()] if m.end() < len(body) else "*"
        if before != "*" and after != "*" and before.isascii() and after.isascii():
            tokens.append(m[0].translate(str.maketrans(ASCII_UPPER, ASCII_UPPER.lower())))
    return tokens


def regular_expression(pattern: str) -> str:
    """Java regular expression for ``find`` over host followed by path."""
    body = pattern[2:] if pattern.startswith("||") else pattern
    start = r"^(?:[^/]*\.)?" if pattern.startswith("||") else ""
    host = len(body.split("/", 1)[0]) if start else 0
    out = [start]
    for at, c in enumerate(body):
        if c == "*":
            out.append("[^/]*" if at < host else "(?s:.*)")
        elif c == "^":
            inside = at < min(host, len(body) - 1)  # what follows is still the host's
            out.append("(?:[^A-Za-z0-9/]|^|$)" if inside else "(?:[^A-Za-z0-9]|^|$)")
        else:
            out.append(c if c.isascii() and (c.isalnum() or c in "/-_") else rf"\x{{{ord(c):x}}}")
    return "".join(out)


def rule_table(pages: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """One row per rule: rank (higher decides), listed, name, verdict, regex, token (the rarest one)."""
    spark = pages.sparkSession
    ordered = sorted(set(rules), key=lambda r: (r.listed, len(r.pattern), r.verdict == "block", r.pattern))
    rows = []
    for rank, r in enumerate(ordered):
        tokens = literal_tokens(r.pattern)
        if not tokens:
            raise ValueError(f"no literal token in {r.pattern!r}")
        rows += [(rank, r.listed, r.pattern.removeprefix("||") if r.listed else r.pattern, r.verdict, regular_expression(r.pattern), t) for t in tokens]
    listed = spark.createDataFrame(rows, "rank int, listed boolean, name string, verdict string, regex string, token string")
    wanted = listed.select("token").distinct()
    seen = pages.select(F.explode(F.array_distinct(url_tokens(F.concat(*host_and_path(F.col("url")))))).alias("token"))
    held = seen.join(_small(wanted, len(rows)), "token").groupBy("token").agg(F.count("*").alias("held"))
    rarest = F.min(F.struct(F.coalesce("held", F.lit(0)), "token")).alias("t")
    return listed.join(held, "token", "left").groupBy("rank", "listed", "name", "verdict", "regex").agg(rarest).select("rank", "listed", "name", "verdict", "regex", "t.token")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_RULES else df


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    both = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    return lower_ascii(F.regexp_extract(text, both, 1)), F.regexp_extract(text, both, 2)


def url_tokens(target: F.Column) -> F.Column:
    return F.filter(F.split(lower_ascii(target), "[^a-z0-9]+"), lambda t: t != "")


def judged(pages: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """page_id, host, path, rule (text of the listed rule, else null), pattern (that decided, else null), verdict.

    One shuffle of (row, page_id, host, path, rank): the tokens of a row are folded on the map side."""
    found = rule_table(pages, rules)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    tokens = F.array_distinct(url_tokens(F.concat("host", "path")))
    candidates = rows.withColumn("token", F.explode_outer(tokens)).join(_small(found, len(rules)).select("rank", "regex", "token"), "token", "left")
    fits = F.expr("CASE WHEN regex IS NOT NULL AND concat(host, path) RLIKE regex THEN rank END")
    best = candidates.groupBy("row", "page_id", "host", "path").agg(F.max(fits).alias("rank"))
    named = best.join(_small(found.select("rank", "listed", "name", "verdict"), len(rules)), "rank", "left")
    return named.select(
        "page_id", "host", "path", F.expr("CASE WHEN listed THEN name END").alias("rule"),
        F.expr("CASE WHEN NOT listed THEN name END").alias("pattern"), F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
