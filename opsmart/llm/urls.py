"""Allow and block rules for web addresses, matched by a sort-merge range join. Built-in functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

START, PAGE, END = 0, 1, 2


def lower_ascii(value: Column) -> Column:
    return F.translate(value, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    """Canonical key: the host's labels from the last one on, then the path, as bytes."""
    return F.concat(F.array_join(labels, "."), F.lit("\u0001"), path).cast("binary")


def match_rules(pages: DataFrame, rules: DataFrame, url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """The rows of ``pages`` with host, path, rule (host and path joined, or null) and verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where the path starts with the rule's; the
    one with the most host labels wins, then the longest path; of equal rules ``block`` wins over ``allow``. Addresses
    without a rule get ``otherwise``.

    An address has one key for each suffix of its host, as deep as the deepest rule; a rule's key is the beginning of
    exactly those keys that it fits, so it is an interval that ends at the key followed by a byte above all
    others. Intervals of prefixes are nested or apart. Keys and interval ends are sorted into ranges; within a
    range the running sum of starts and ends is the height of the stack of open rules, and a key's rule is the last one that was
    opened at the key's height. Rules that are open across ranges are opened again at the start of each.

    Distinct keys are swept, then joined back, so a host or address that a third of all rows share is no
    hot spot in the sweep. A null address or one without ``://`` has an empty host and path. Repeated rows and all columns of
    ``pages`` stay, except that host, path, rule and verdict are replaced. Empty tables give empty results or no rule.
    """
    rules = rules.select(
        F.coalesce(lower_ascii(F.col("host")), F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = materialize(rules.withColumn("key", _key(_labels(F.col("host")), F.col("path"))))
    depth, reach = rules.agg(F.max(F.size(_labels(F.col("host")))), F.max(F.length("path"))).first()
    depth, reach = depth or 1, reach or 0
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c.lower() not in new]
    url = F.col(f"`{url_col}`")
    judged = pages.select(*(F.col(f"`{c}`") for c in kept), host_of(url).alias("host"), path_of(url).alias("path"))
    # only so much of a path as the longest rule's can decide
    head = F.substring("path", 1, reach)
    places = judged.select("host", head.alias("head")).distinct()
    labels = _labels(F.col("host"))
    suffixes = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth)))
    keyed = places.select("host", "head", F.explode(suffixes).alias("labels"))
    keyed = keyed.withColumn("key", _key(F.slice(labels, F.lit(1), F.col("labels")), F.col("head")))
    top = _sweep(keyed.select("key").distinct(), rules.select("key"))
    best = keyed.join(top, "key").groupBy("host", "head").agg(F.max_by("rule_key", "labels").alias("rule_key"))
    named = best.join(
        rules.select(F.col("key").alias("rule_key"), F.concat("host", "path").alias("rule"), "verdict"), "rule_key"
    ).select(F.col("host").alias("__host"), F.col("head").alias("__head"), "rule", "verdict")
    named = materialize(named)  # a plain table, so that Spark can split a host with a third of all rows in the join
    joined = judged.join(named, (F.col("host") == F.col("__host")) & (head == F.col("__head")), "left")
    return joined.select(
        *(F.col(f"`{c}`") for c in kept), "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )


def _sweep(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, rule_key) for every key inside a rule's interval; the rule is the innermost one."""
    none = F.lit(None).cast("binary")
    starts = rules.select("key", F.lit(START).alias("kind"), F.col("key").alias("rule_key"))
    ends = rules.select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(END).alias("kind"), F.col("key").alias("rule_key"))
    events = keys.select("key", F.lit(PAGE).alias("kind"), none.alias("rule_key")).unionByName(starts).unionByName(ends)
    ranged = materialize(events.repartitionByRange("key").withColumn("range", F.spark_partition_id()))
    spans = ranged.filter(F.col("kind") != PAGE).groupBy("rule_key").agg(F.min("range").alias("a"), F.max("range").alias("b"))
    carried = spans.filter("a < b").select(
        F.col("rule_key").alias("key"), F.lit(START).alias("kind"), "rule_key", F.explode(F.sequence(F.col("a") + 1, "b")).alias("range")
    )
    order = ["key", "kind"]
    step = F.when(F.col("kind") == START, 1).when(F.col("kind") == END, -1).otherwise(0)
    so_far = W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    stacked = ranged.unionByName(carried).withColumn("height", F.sum(step).over(so_far))
    opened = W.partitionBy("range", "height").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.last(F.when(F.col("kind") == START, F.col("rule_key")), ignorenulls=True).over(opened)
    found = stacked.withColumn("top", last).filter((F.col("kind") == PAGE) & (F.col("height") > 0))
    return found.select("key", F.col("top").alias("rule_key"))
