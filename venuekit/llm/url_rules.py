"""Judge addresses by block and allow rules of a host and a path prefix.

Each address is spelled out as expressions, a suffix of its host with a prefix of its path.
Expressions and rules meet in an equi-join on the first bytes of their digests; the full
digests then confirm the match, and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.cluster import fresh

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hex digits of a digest that the join compares.
PREFIX = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _suffixes(host: Column, labels: list[int]) -> Column:
    """The ends of a host that have as many labels as some rule, which are few, however many the host has."""
    fitting = F.filter(F.lit(labels), lambda n: n <= _labels(host))
    return F.transform(fitting, lambda n: F.call_function("substring_index", host, F.lit("."), -n))


def _prefixes(path: Column, lengths: list[int]) -> Column:
    fitting = F.filter(F.lit(lengths), lambda n: n <= F.length(path))
    return F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, with an underscore in front where the input has the name.

    ``rules`` has ``host``, ``path`` and ``verdict``; a rule fits its host and every subdomain when
    the address's path starts with the rule's.  Of several the longest wins, then the one with the
    longer host, then ``block``.  Without a rule ``rule`` is null and the verdict is ``default``; so
    it is for a null address or one without ``://``, whose host and path are empty.
    Lengths of paths and numbers of labels are taken from the rules, so that any host and path can be a rule; there are no
    more of them than characters in the longest rule.  Each different host and path is judged once.
    """
    spelled = (
        rules.where("host <> ''")
        .select(F.translate("host", UPPER, UPPER.lower()).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
        .withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("rule_key", F.substring("rule_digest", 1, PREFIX))
    )
    lengths = sorted(r[0] for r in spelled.select(F.length("rule_path")).distinct().collect())
    labels = sorted(r[0] for r in spelled.select(_labels(F.col("rule_host"))).distinct().collect())
    names = {c: fresh(pages, c) for c in ("host", "path", "rule", "verdict")}
    # the input's columns travel as one, so that no name can clash
    placed = pages.select(F.struct(*pages.columns).alias("row"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    lengths_array = lengths or [0]
    places = placed.select("host", "path").distinct()
    expressions = (
        places.where("host <> ''")
        .select("host", "path", F.explode(_suffixes(F.col("host"), labels or [0])).alias("suffix"))
        .select("host", "path", "suffix", F.explode(_prefixes(F.col("path"), lengths_array)).alias("prefix"))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("key", F.substring("digest", 1, PREFIX))
    )
    confirmed = (F.col("digest") == F.col("rule_digest")) & (F.col("suffix") == F.col("rule_host")) & (F.col("prefix") == F.col("rule_path"))
    size = F.length("rule_host") + F.length("rule_path")
    order = F.struct(size, F.length("rule_host"), (F.col("rule_verdict") == "block").cast("int"))
    best = (
        expressions.join(spelled, F.col("key") == F.col("rule_key"))
        .where(confirmed)
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), order).alias("best"))
    )
    judged = placed.join(best, ["host", "path"], "left").withColumns({"rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(default))})
    return judged.select("row.*", *(F.col(c).alias(name) for c, name in names.items()))
