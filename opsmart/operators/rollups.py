"""Aggregations that are used by more than one model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import exact_avg, exact_sum


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *columns)


def totals_by(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Sum per key, largest first; without keys the grand total."""
    totals = df.groupBy(*keys).agg(exact_sum(value).alias(f"total_{value}"))
    return totals.orderBy(F.desc(f"total_{value}"), *keys) if keys else totals


def profile(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        exact_avg(column).alias("avg_value"),
        F.count(column).alias("non_null"),
    )


def distinct_values(df: DataFrame, column: str, newest: int | None = None) -> DataFrame:
    """Distinct values in ascending order; with ``newest`` only the last so many."""
    values = df.select(column).distinct()
    if newest is None:
        return values.orderBy(F.col(column).asc_nulls_last())
    return values.orderBy(F.col(column).desc_nulls_last()).limit(newest).orderBy(column)


def most_frequent(
    df: DataFrame, keys: Sequence[str], value: str, output: str,
    measures: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Most frequent non-NULL value per key, lowest value on ties, next to other measures.

    Counts per (key, value) come first, so a hot key is spread over its values and
    only one small row per value reaches the second step. ``measures`` maps an
    output name to (partial aggregate, final aggregate over the partial column ``name``).
    """
    measures = measures or {}
    partial = df.groupBy(*keys, value).agg(
        F.count(value).alias("__n"), *[first.alias(name) for name, (first, _) in measures.items()]
    )
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v"))))
    return (
        partial.groupBy(*keys)
        .agg(best.alias("__best"), *[final.alias(name) for name, (_, final) in measures.items()])
        .withColumn(output, F.col("__best.v"))
        .drop("__best")
    )


def mix_within(df: DataFrame, group: str, member: str, digits: int = 4) -> DataFrame:
    """Count of each member inside its group and its share of the group. A NULL group is a group of its own."""
    counts = df.groupBy(group, member).agg(F.count("*").alias("count"))
    totals = counts.groupBy(F.col(group).alias("__group")).agg(F.sum("count").alias("group_count"))
    joined = counts.join(totals, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    return joined.withColumn("share", F.round(F.col("count") / F.col("group_count"), digits))
