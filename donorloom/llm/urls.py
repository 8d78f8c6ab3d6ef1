"""URL filters: pattern rules indexed by their rarest literal token."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorloom.llm.common import ascii_lower

MAX_RULES = 100_000  # rules are a parameter, and their index is broadcast


@dataclass(frozen=True)
class Rule:
    """``pattern`` is tried on ``host + path`` (a line feed between them) of URLs that hold one of its ``tokens``.

    ``tokens`` are runs of a-z and 0-9 that every matching URL has as whole
    tokens, lower-cased. Rules of a higher level go first, then longer texts.
    """

    text: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    level: int = 0


def _tokens(text: str) -> list[str]:
    out, run = [], ""
    for c in text.lower() + " ":
        if c.isascii() and c.isalnum():
            run += c
        elif run:
            out.append(run)
            run = ""
    return out


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else f"\\{c}" for c in text)


def site_rule(verdict: str, text: str, level: int = 1) -> Rule:
    """A rule ``host/path``: fits the host and its subdomains where the path starts with the rule's."""
    host, slash, rest = text.partition("/")
    path = slash + rest
    whole = _tokens(path if path[-1:] and not path[-1:].isalnum() else path[: max(0, path.rfind("/") + 1)])
    return Rule(text, rf"^(?:[^\n]*\.)?{_quoted(host)}\n{_quoted(path)}", tuple(dict.fromkeys([*_tokens(host), *whole])), verdict, level)


BASE = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: What the method says of URLs that no site rule fits: the literal token is required, the pattern decides.
OWN = (
    Rule("ads host", r"^(?:[^\n]*\.)?ads?\.[^\n]*\n", ("ads",), "block"),
    Rule("mobile mirror", r"^m\.[^\n]*\n", ("m",), "block"),
    Rule("login page", r"\n/(?:[^\n]*/)?login(?:[/.]|\z)", ("login",), "block"),
    Rule("search page", r"\n/(?:[^\n]*/)?search(?:[/.]|\z)", ("search",), "block"),
    Rule("static html", r"\n/[a-z]{2}/[0-9]+\.html\z", ("html",), "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule] = (*[site_rule(v, t) for v, t in BASE], *OWN), otherwise: str = "allow",
) -> DataFrame:
    """One row per row of ``pages(page_id, url)``: page_id, host, path, rule, verdict, pattern.

    Each rule waits at one literal token: of its tokens the one that the fewest
    URLs of the table hold (ties to the first in order). A URL's distinct tokens
    fetch candidate rules from that broadcast index, and only their patterns are
    tried. Site rules (level 1) go before the method's own; then the longest
    text wins. ``rule`` names a site rule, ``pattern`` the rule of either kind
    that decided; without one the verdict is ``otherwise``. URLs that are null
    or have no ``://`` have an empty host and path and no candidate. Repeated
    rows are judged each, an empty table gives an empty one, other columns are
    not looked at. A rule without a token is an error.
    """
    if len(rules) > MAX_RULES or any(not r.tokens for r in rules):
        raise ValueError(f"at most {MAX_RULES} rules, each with a literal token")
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    site = F.concat("host", F.lit("\n"), "path")
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.concat_ws(" ", "host", "path")), F.lit("([a-z0-9]+)"), F.lit(1)))

    schema = "no int, text string, pattern string, token string, verdict string, level int, place int"
    table = spark.createDataFrame([(i, r.text, r.pattern, t, r.verdict, r.level, p) for i, r in enumerate(rules)
                                   for p, t in enumerate(r.tokens)], schema)
    # How many URLs hold each token that a rule knows: as many rows as there are rule tokens.
    seen = rows.select(F.explode(found).alias("token")).join(F.broadcast(table.select("token").distinct()), "token")
    seen = seen.groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    index = table.join(F.broadcast(seen), "token", "left").groupBy("no", "text", "pattern", "verdict", "level").agg(
        F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "place")).alias("token"))

    tried = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("token", F.explode_outer(found))
    tried = tried.join(F.broadcast(index), "token", "left")
    fits = F.expr("rlike(concat(host, '\n', path), pattern)")
    best = F.struct("level", F.length("text").alias("n"), (-F.col("no")).alias("no"), "text", "verdict")
    # A URL's tokens are together, so this grouping is complete before its shuffle.
    judged = tried.groupBy("_row", "page_id", "host", "path").agg(F.max(F.when(fits, best)).alias("best"))
    return judged.select(
        "page_id", "host", "path", F.when(F.col("best.level") >= 1, F.col("best.text")).alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"), F.col("best.text").alias("pattern"))


def oracle(rules: Sequence[Rule] = (*[site_rule(v, t) for v, t in BASE], *OWN), otherwise: str = "allow") -> str:
    """The same verdicts in DuckDB SQL, every pattern tried on every URL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(r.text)}, {quote(r.pattern)}, {quote(r.verdict)}, {r.level})" for i, r in enumerate(rules))
    return rf"""
WITH r(no, text, pattern, verdict, level) AS (VALUES {values}),
s AS (SELECT row_number() OVER () AS k, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
j AS (SELECT k, max(struct_pack(level := level, n := length(text), no := -no, text := text, verdict := verdict)) AS best
      FROM h, r WHERE regexp_matches(host || chr(10) || path, pattern) GROUP BY k)
SELECT page_id, host, path, CASE WHEN best.level >= 1 THEN best.text END AS rule,
       coalesce(best.verdict, '{otherwise}') AS verdict, best.text AS pattern
FROM h LEFT JOIN j USING (k)"""
