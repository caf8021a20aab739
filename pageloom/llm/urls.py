"""URL filters: pattern rules indexed by their rarest literal token.

A rule is ``host/path``. It fits its host and all subdomains when the address path starts with the rule's
path. Every rule is filed under one of its literal tokens (host labels and whole path segments), the one
that fewest rows of the address table carry. The tokens of an address fetch the rules filed under them,
and only those candidates run their regular expression; the longest fitting rule decides.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import ascii_lower

#: Filed under this token: rules without any literal token. Every address carries it.
ANY = ""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' for null or no ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; '' for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_tokens(rule: str) -> list[str]:
    """Literal tokens that every address fitting the rule must carry: ``h:label`` and ``p:segment``.

    A last segment without closing slash is a prefix only, so it is no token."""
    host, _, path = rule.partition("/")
    return [f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in path.split("/")[:-1] if x]


def rule_pattern(rule: str) -> str:
    """A regular expression on ``host + path``."""
    host, slash, path = rule.partition("/")
    before = rf"^(?:[^/]*\.)?{_quoted(host)}" if host else "^[^/]*"
    return before + (_quoted(slash + path) if slash else "(?:/|$)")


def _quoted(text: str) -> str:
    return re.sub(r"[^\w]", lambda m: "\\" + m[0] if m[0].isascii() else m[0], text)


def url_tokens(host: Column, path: Column) -> Column:
    """The distinct tokens of an address, with the one that stands for all addresses."""
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    return F.array_distinct(F.concat(
        F.array(F.lit(ANY)), named("h:", F.split(host, r"\.")), named("p:", F.split(path, "/"))))


def index_rules(addresses: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``(token, rule, rule_length, pattern, rule_verdict)``: each rule under its rarest token.

    ``addresses`` has the columns host and path. Frequencies count all of its rows, at the tokens of the
    rules only; ties go to the token that sorts first."""
    spark = addresses.sparkSession
    rows = [(t, rule, len(rule), rule_pattern(rule), verdict) for rule, verdict in dict(rules).items()
            for t in (rule_tokens(rule) or [ANY])]
    schema = "token string, rule string, rule_length int, pattern string, rule_verdict string"
    offered = spark.createDataFrame(rows, schema)
    wanted = offered.select("token").distinct()
    seen = addresses.select(F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token")).join(wanted, "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("seen"))
    best = offered.join(counts, "token", "left").groupBy("rule", "rule_length", "pattern", "rule_verdict").agg(
        F.min_by("token", F.struct(F.coalesce("seen", F.lit(0)), "token")).alias("token"))
    return best.select("token", "rule", "rule_length", "pattern", "rule_verdict")


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``(id, host, path, rule, verdict)``, one row per input row.

    ``rules`` holds pairs of rule and verdict; of rules of one length that fit, the one that sorts first
    decides; a rule given twice counts with its last verdict. A null address or one without ``://`` has an
    empty host and path; only a rule with an empty host can fit it. Repeated rows and null ids stay, each
    row with its verdict. Other columns of ``pages`` are not read. An empty table gives an empty result.

    Rows that agree in id and address are judged once and counted. The rules join by token: Spark sends
    them to all tasks while their measured size is below its broadcast threshold, and otherwise sorts
    and merges, where a token that a third of all addresses carry is split by adaptive execution."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    found = rows.select("id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    index = index_rules(found, rules)
    # the null token stands for the row itself: it meets no rule, so it counts the row exactly once
    tokens = F.explode(F.concat(F.array(F.lit(None).cast("string")), url_tokens(F.col("host"), F.col("path"))))
    fits = F.expr("concat(host, path) rlike pattern")
    judged = found.select("*", tokens.alias("token")).join(index, "token", "left").select(
        "id", "url", "host", "path", F.col("token").isNull().cast("int").alias("copy"),
        F.when(fits, F.struct((-F.col("rule_length")).alias("rank"), "rule", "rule_verdict")).alias("hit"))
    best = judged.groupBy("id", "url", "host", "path").agg(F.sum("copy").cast("int").alias("copies"), F.min("hit").alias("hit"))
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.rule_verdict", F.lit(default)).alias("verdict"))


