"""URL verdicts from host-suffix and path-prefix rules, by hashed expressions.

A url is expanded into every host suffix joined with every path prefix that a
rule could name.  Expressions meet the rules in an equi-join on the first four
bytes of their SHA-256; the whole digest then confirms a hit, and the longest
rule wins.  Only DataFrame functions run.

Distinct urls are expanded once and joined back, so a url that fills a third of
the rows costs one expansion; that join reads the many rows on its streamed
side, where adaptive execution splits them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8  # hexadecimal digits of a digest that the join uses


def host_of(url: Column) -> Column:
    """Host of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(_rest(url), r"\A([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """Path of a url: what follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _suffixes(host: Column, labels: Column) -> Column:
    """The host and its parents, of at most ``labels`` labels."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), F.least(n, labels)), lambda k: F.concat_ws(".", F.slice(parts, n - k + 1, k)))


def _prefixes(path: Column, lengths: Column) -> Column:
    """Prefixes of the path, of the lengths that rules have."""
    return F.transform(F.filter(lengths, lambda k: k <= F.length(path)), lambda k: F.substring(path, F.lit(1), k))


def url_verdicts(pages: DataFrame, rules: DataFrame, *, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (page_id, url).

    ``rules`` has host, path and verdict; a rule fits its host and all
    subdomains where the url's path starts with the rule's path.  The longest
    rule wins; of equally long ones a block wins.  ``rule`` is host and path
    joined, null where none fits; then the verdict is ``default``.

    A null url, or one without ``://``, has an empty host and path.  Repeated
    rows are all kept, an empty table gives none, other columns are dropped.
    Only expressions with a rule's number of labels or path length are made, so
    a very long url adds no more than the rules can match.
    """
    rules = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    rules = rules.filter(F.col("rule_host").isNotNull() & F.col("rule_path").isNotNull())
    expression = F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256)
    rules = rules.withColumn("digest", expression).withColumn("prefix", F.substring("digest", 1, PREFIX))
    shape = rules.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"), F.collect_set(F.length("rule_path")).alias("lengths")).first()
    labels, lengths = shape["labels"] or 1, sorted(shape["lengths"])

    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    known = F.array(*[F.lit(k) for k in lengths]).cast("array<int>")
    urls = pages.filter(F.instr("url", "://") > 0).select("url").distinct()
    urls = urls.select("url", _suffixes(host_of(F.col("url")), F.lit(labels)).alias("hosts"), _prefixes(path_of(F.col("url")), known).alias("paths"))
    pairs = urls.select("url", F.explode("hosts").alias("h"), "paths").select("url", "h", F.explode("paths").alias("p"))
    wanted = pairs.select("url", F.sha2(F.concat_ws("\n", "h", "p"), 256).alias("wanted")).withColumn("prefix", F.substring("wanted", 1, PREFIX))
    hits = wanted.join(rules, "prefix").filter(F.col("wanted") == F.col("digest"))
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("rule_verdict") == "block")
    best = hits.groupBy("url").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), rank).alias("best"))
    judged = pages.join(best, "url", "left")
    host, path = F.coalesce(host_of(F.col("url")), F.lit("")), F.coalesce(path_of(F.col("url")), F.lit(""))
    return judged.select("page_id", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
