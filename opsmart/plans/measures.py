"""Dashboard measures. Each function returns one row; ``as_rows`` turns it into (measure, value) rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.core import exact_avg, exact_sum
from ..operators.reshape import cross_tab


def safe_share(part: Column, whole: Column) -> Column:
    """Share of two counts, 0 when there is nothing to count."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def stress(daily: DataFrame, high_from: float = rules.DASHBOARD_HIGH_STRESS, elevated_from: float = 4, high_label: str = "High") -> DataFrame:
    """The published label 'High' is none of the risk labels, so its share is 0 unless another label is given.

    Elevated days have no published limits; ours are [``elevated_from``, ``high_from``).
    """
    score = F.col("operational_stress_score")
    return daily.agg(
        exact_avg(score).alias("avg_stress_score"),
        F.max(score).alias("peak_stress_score"),
        F.count_if(score >= high_from).alias("high_stress_days"),
        F.count_if((score >= elevated_from) & (score < high_from)).alias("elevated_stress_days"),
        safe_share(F.count_if(F.col("ops_risk_label") == high_label), F.count("*")).alias("high_risk_day_share"),
    )


def outages(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.sum("total_outages").alias("total_outages"),
        exact_sum("total_customer_minutes_lost").alias("total_cml"),
        F.sum("total_customers_affected").alias("total_customers_affected"),
        exact_avg("avg_outage_duration_hrs").alias("avg_outage_duration"),
        F.sum("weather_driven_outages").alias("weather_driven_outages"),
        F.sum("unplanned_outages").alias("unplanned_outages"),
    )


def spend(mart: DataFrame) -> DataFrame:
    return mart.agg(
        exact_sum("amount_usd").alias("total_om_spend"),
        exact_avg("cost_per_risk_point").alias("avg_cost_per_risk_point"),
        F.count_if(F.col("is_high_spend") == 1).alias("high_spend_count"),
        exact_avg("avg_risk_score").alias("avg_om_risk_score"),
    )


def workforce(mart: DataFrame) -> DataFrame:
    return mart.agg(
        exact_sum("labor_cost").alias("total_labor_cost"),
        exact_sum("overtime_premium_cost").alias("total_overtime_cost"),
        exact_sum("hours_worked").alias("total_hours_worked"),
    )


def safety(mart: DataFrame) -> DataFrame:
    return mart.agg(
        exact_avg("safety_risk_index").alias("avg_safety_risk"),
        F.count_if(F.col("is_incident") == 1).alias("total_incidents"),
        F.count_if(F.col("is_overdue") == 1).alias("overdue_closures"),
    )


def market(mart: DataFrame) -> DataFrame:
    return mart.agg(
        exact_sum("revenue_usd").alias("total_revenue"),
        exact_sum("sales_mwh").alias("total_sales_mwh"),
        exact_avg("price_usd_per_kwh").alias("avg_price_per_kwh"),
        exact_sum("customers").alias("total_customers"),
    )


def as_rows(measures: DataFrame, board: str) -> DataFrame:
    cells = [F.struct(F.lit(board).alias("board"), F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures.columns]
    return measures.select(F.inline(F.array(*cells)))


def by(df: DataFrame, measure: Column, name: str, *dimensions: str) -> DataFrame:
    """One chart: a measure per value of one or two dimensions."""
    return df.groupBy(*dimensions).agg(measure.alias(name))


def charts(df: DataFrame, values: Mapping[str, Column], boards: Mapping[str, Sequence[str]]) -> DataFrame:
    """All charts of a board from one scan: (chart, every dimension, every measure).

    ``boards`` names the dimensions of each chart; in its rows the dimensions of the others are NULL. Charts with the
    same dimensions are one chart. The scan is grouped by all sets of dimensions at once.
    """
    dimensions = list(dict.fromkeys(c for columns in boards.values() for c in columns))
    number = {name: sum(1 << (len(dimensions) - 1 - i) for i, c in enumerate(dimensions) if c not in columns) for name, columns in boards.items()}
    sets = [[F.col(c) for c in columns] for columns in boards.values()]
    grouped = df.groupingSets(sets, *(F.col(c) for c in dimensions)).agg(
        F.grouping_id().alias("__set"), *(v.alias(n) for n, v in values.items())
    )
    chart = F.coalesce(*(F.when(F.col("__set") == n, F.lit(name)) for name, n in number.items()))
    return grouped.select(chart.alias("chart"), *dimensions, *values)


def matrix(df: DataFrame, row: str, column: str, values, measure: Column) -> DataFrame:
    return cross_tab(df, row, column, values, measure)
