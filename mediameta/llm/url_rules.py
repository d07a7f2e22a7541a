"""Operator 3, URL filters: pattern rules indexed by their rarest literal token, with DataFrame functions only.

A rule's literal tokens (runs of letters and digits that its pattern fixes whole) are looked up in the table's token
counts, and the rarest becomes the rule's key. A URL's tokens fetch the rules with such a key by a broadcast join, and only
those candidates run their regular expressions. The longest matching rule wins.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: What a URL gets that no rule fits.
DEFAULT = "allow"
#: Rules are broadcast, so there may be at most so many.
MOST_RULES = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_TOKEN = "[^0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """Fits host and path written together: a host has no slash, a path begins with one or is empty."""
        behind = "" if self.path else r"(?:/|\z)"
        return r"(?s)^(?:[^/]*\.)?" + quoted(self.host) + quoted(self.path) + behind

    @property
    def tokens(self) -> tuple[str, ...]:
        """Literal tokens that every fitting URL has; the path's last run may go on in the URL, so it does not count."""
        inner = re.split(NOT_TOKEN, self.path)[:-1]
        return tuple(sorted({t for t in [*re.split(NOT_TOKEN, self.host), *inner] if t}))


def quoted(text: str) -> str:
    return re.sub(r"([^0-9A-Za-z_/])", r"\\\1", text) if text.isascii() else re.escape(text)


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, with the empty one, under which rules without a token are kept."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.concat(host, F.lit("/"), path), NOT_TOKEN)))


def rule_frame(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """The rules with text, verdict, pattern and tokens."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    if len({r.text for r in rules}) < len(rules):
        raise ValueError("two rules for the same host and path")
    rows = [(r.text, r.verdict, r.pattern, list(r.tokens)) for r in rules]
    return spark.createDataFrame(rows, "rule string, verdict string, pattern string, tokens array<string>")


def index_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under its rarest token, by the counts of the tokens in ``urls`` (column ``tokens``); token, rule, verdict, pattern.

    Only the rules' own tokens are counted. Ties go to the longer, then the smaller token.
    """
    used = rules.select("rule", F.explode_outer("tokens").alias("token")).na.fill("", ["token"])
    seen = urls.select(F.explode("tokens").alias("token")).join(F.broadcast(used.select("token").distinct()), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = used.join(F.broadcast(counts), "token", "left").select("rule", F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.length("token")).alias("short"), "token").alias("key"))
    best = ranked.groupBy("rule").agg(F.min("key")["token"].alias("token"))
    return best.join(F.broadcast(rules.drop("tokens")), "rule")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = tuple(Rule(*r) for r in RULES), id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits) and verdict.

    A URL that is null or has no ``://`` has empty host and path. Among fitting rules the longest host and path wins, of
    equally long ones the greater text. Repeated rows are judged once and returned as often as they come; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    listed = rule_frame(spark, rules)
    parts = pages.select(pages[id_col].alias(id_col), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"))
    key = [id_col, "host", "path"]
    rows = parts.groupBy(*key).agg(F.count(F.lit(1)).alias("__times"))
    urls = rows.withColumn("tokens", tokens_of(F.col("host"), F.col("path")))
    index = index_rules(parts.select(tokens_of(F.col("host"), F.col("path")).alias("tokens")), listed)
    candidates = urls.withColumn("token", F.explode("tokens")).drop("tokens").join(F.broadcast(index), "token", "left")
    fits = F.expr("concat(host, path) RLIKE pattern")
    best = F.max(F.when(fits, F.struct(F.length("rule").alias("size"), "rule", "verdict"))).alias("__best")
    judged = candidates.groupBy(*key, "__times").agg(best)
    return judged.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(
        *key, F.col("__best.rule").alias("rule"), F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict")
    )
