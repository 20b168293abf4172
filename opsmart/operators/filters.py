"""Row selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the newest period of the whole table.

    The maximum is a scalar subquery over one column. Its value is known before
    the main scan starts, so the filter reaches the Parquet reader.
    """
    newest = df.agg(F.max(period)).scalar()
    return df.filter(F.col(period) == newest)


def except_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose value differs; NULL rows are dropped too."""
    return df.filter(F.col(column) != value)


def facets(df: DataFrame, **allowed: Sequence) -> DataFrame:
    """Keep rows whose columns hold one of the allowed values."""
    for name, values in allowed.items():
        df = df.filter(F.col(name).isin(list(values)))
    return df


def between(df: DataFrame, column: str, first, last) -> DataFrame:
    """Both ends included. The bare column is compared, so the range reaches the reader."""
    return df.filter(F.col(column).between(F.lit(first), F.lit(last)))


def relative_window(df: DataFrame, column: str, as_of: dt.date, oldest_days: int = 90, newest_days: int = 5) -> DataFrame:
    """Rows from ``as_of - oldest_days`` up to and including the day ``as_of - newest_days``.

    Works for date and timestamp columns: the upper end is an exclusive next-day limit.
    """
    first = as_of - dt.timedelta(days=oldest_days)
    after = as_of - dt.timedelta(days=newest_days - 1)
    kind = df.schema[column].dataType.typeName()
    low, high = F.lit(first).cast(kind), F.lit(after).cast(kind)
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def at_least(df: DataFrame, column: str, threshold: float, keep: Sequence[str] | None = None) -> DataFrame:
    df = df.filter(F.col(column) >= threshold)
    return df.select(*keep) if keep else df


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of a total order. Spark keeps ``k`` rows per task, nothing is fully sorted."""
    return df.orderBy(*order).limit(k)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def first_non_empty(first: DataFrame, second: DataFrame) -> DataFrame:
    """The second source only when the first has no row. The choice is part of the plan: no job runs to make it."""
    return first.unionByName(second.filter(~first.exists()))


def present_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [name for name in wanted if name in df.columns]


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
