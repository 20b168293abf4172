"""Wide and long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import text_or_empty, to_number


def melt_with_units(
    df: DataFrame, ids: Sequence[str | Column], metrics: Sequence[str],
    name: str = "data_type", value: str = "value", unit: str = "unit", unit_suffix: str = "-units",
) -> DataFrame:
    """One row per input row and metric present, with the metric's own unit column if there is one."""
    present = [m for m in metrics if m in df.columns]
    cells = [
        F.struct(
            F.lit(m).alias(name),
            to_number(F.col(f"`{m}`").cast("string")).alias(value),
            (text_or_empty(F.col(f"`{m}{unit_suffix}`")) if f"{m}{unit_suffix}" in df.columns else F.lit("")).alias(unit),
        )
        for m in metrics
        if m in present
    ]
    return df.select(*ids, F.inline(F.array(*cells)))


def pivot_max(df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Sequence[str]) -> DataFrame:
    """One row per key and one column per listed name; a missing cell is NULL."""
    return df.groupBy(*keys).pivot(name, list(columns)).agg(F.max(value))


def cross_tab(df: DataFrame, row: str, column: str, values: Sequence, measure: Column) -> DataFrame:
    """Matrix of one measure. The column values are listed, so no extra pass looks for them."""
    return df.groupBy(row).pivot(column, list(values)).agg(measure)


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    head, *rest = frames
    for frame in rest:
        head = head.unionByName(frame)
    return head
