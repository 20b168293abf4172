"""Joins. No side is forced to be broadcast: Spark decides from measured sizes
(``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution) and splits
skewed partitions of sort-merge joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_context(fact: DataFrame, context: DataFrame, keys: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Keep every fact row and add ``columns`` of the context row with equal keys.

    ``keys`` maps fact column -> context column. The context must have one row per key.
    """
    renamed = context.select(
        *[F.col(theirs).alias(f"__key_{ours}") for ours, theirs in keys.items()], *columns
    )
    condition = [F.col(ours) == F.col(f"__key_{ours}") for ours in keys]
    return fact.join(renamed, condition, "left").drop(*[f"__key_{ours}" for ours in keys])


def spine_join(spine: DataFrame, facts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left join facts that were already aggregated to the spine's grain.

    All joins use the same keys and the facts leave their aggregation hashed on
    those keys, so only the spine is shuffled once.
    """
    for fact in facts:
        spine = spine.join(fact, list(keys), "left")
    return spine


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def join_on_expression(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, columns: Sequence[str]) -> DataFrame:
    """Left join on two computed keys, such as place names in different spellings."""
    keyed = right.select(right_key.alias("__key"), *columns)
    return left.withColumn("__left_key", left_key).join(keyed, F.col("__left_key") == F.col("__key"), "left").drop("__left_key", "__key")


def with_labels(df: DataFrame, labels: DataFrame, code: str, label: str, output: str) -> DataFrame:
    """Label of a code from a dimension table, the code itself where the table has none."""
    table = labels.select(F.col(code).alias("__code"), F.col(label).alias("__label"))
    return (
        df.join(table, F.col(code) == F.col("__code"), "left")
        .withColumn(output, F.coalesce("__label", code))
        .drop("__code", "__label")
    )


def expand_with(df: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    """One row per input row and combination of the given short value lists.

    Array literals are exploded inside each task, there is no cross join.
    """
    for name, members in values.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(m) for m in members])))
    return df


def coverage_gaps(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected key combinations for which no actual row exists."""
    return expected.join(actual.select(*keys), list(keys), "left_anti")
