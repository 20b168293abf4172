"""City, season, month and network summaries of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import field
from ..functions.core import exact_avg, exact_sum
from ..operators import filters, ordered
from ..operators.joins import join_on_expression


def _avg(column: str, digits: int):
    return F.round(exact_avg(column), digits)


def city_summary(daily: DataFrame) -> DataFrame:
    return daily.groupBy("city_name").agg(
        F.count("*").alias("total_days"),
        _avg("total_outages", 2).alias("avg_daily_outages"),
        exact_sum("total_outages").alias("total_outages"),
        _avg("total_customer_minutes_lost", 0).alias("avg_customer_minutes_lost"),
        exact_sum("total_customer_minutes_lost").alias("total_customer_minutes_lost"),
        _avg("total_crews_deployed", 2).alias("avg_crews_per_day"),
        F.round(exact_sum("total_labor_cost"), 2).alias("total_labor_cost"),
        _avg("operational_stress_score", 3).alias("avg_stress_score"),
        F.round(F.max("operational_stress_score"), 3).alias("peak_stress_score"),
        _avg("temp_avg_f", 1).alias("avg_temperature_f"),
        _avg("heating_degree_days", 1).alias("avg_heating_degree_days"),
        _avg("cooling_degree_days", 1).alias("avg_cooling_degree_days"),
    )


def ranked_cities(daily: DataFrame) -> DataFrame:
    """City summary with its stress rank (1 is the most stressed) and risk label."""
    ranked = ordered.rank_descending(city_summary(daily), "avg_stress_score", "stress_rank")
    return ranked.withColumn("risk_label", field.city_risk_label("avg_stress_score"))


def high_stress_days(daily: DataFrame, threshold: float = rules.HIGH_STRESS_DAY) -> DataFrame:
    """Days at or above the threshold; show the first ten with ``top_high_stress_days``."""
    keep = [
        "summary_date", "city_name", "operational_stress_score", "total_outages",
        "total_customer_minutes_lost", "ops_risk_label", "season",
    ]
    return filters.at_least(daily, "operational_stress_score", threshold, keep)


def top_high_stress_days(daily: DataFrame, k: int = 10, threshold: float = rules.HIGH_STRESS_DAY) -> DataFrame:
    days = high_stress_days(daily, threshold)
    return filters.top_k(days, k, F.desc("operational_stress_score"), F.asc("summary_date"), F.asc("city_name"))


def seasonal_summary(daily: DataFrame) -> DataFrame:
    return daily.groupBy("season").agg(
        F.count("*").alias("total_days"),
        _avg("total_outages", 2).alias("avg_outages"),
        _avg("total_customer_minutes_lost", 0).alias("avg_cml"),
        _avg("operational_stress_score", 3).alias("avg_stress"),
        F.round(exact_sum("total_labor_cost"), 2).alias("total_labor_cost"),
    ).orderBy(F.desc("avg_stress"), "season")


def grid_by_city(grid_mart: DataFrame) -> DataFrame:
    return grid_mart.groupBy(F.col("city").alias("city_name")).agg(
        F.count("*").alias("facility_count"),
        _avg("betweenness_centrality", 3).alias("avg_betweenness"),
        F.round(F.max("betweenness_centrality"), 3).alias("max_betweenness"),
        _avg("network_importance_score", 1).alias("avg_importance_score"),
        F.sum("capacity_mw").alias("total_capacity_mw"),
    )


def cities_with_grid(ranked: DataFrame, grid_cities: DataFrame) -> DataFrame:
    """Ranked cities next to their network, joined on names with underscores read as spaces."""
    joined = join_on_expression(
        ranked, grid_cities, field.clean_place("city_name"), field.clean_place("city_name"),
        ["facility_count", "total_capacity_mw", "avg_importance_score", "avg_betweenness"],
    )
    return joined.select(
        "city_name", "stress_rank", "risk_label", "avg_stress_score", "avg_daily_outages",
        "facility_count", "total_capacity_mw", "avg_importance_score", "avg_betweenness",
    )


def monthly_risk(weather_mart: DataFrame) -> DataFrame:
    return weather_mart.groupBy("city_name", "month_num", "year", "season").agg(
        F.sum("ops_risk_score").alias("total_risk"),
        exact_avg("ops_risk_score").alias("avg_risk"),
        F.sum("is_high_wind").alias("wind_days"),
        F.sum("is_freeze_risk").alias("freeze_days"),
        F.sum("is_heat_alert").alias("heat_days"),
        F.count("*").alias("total_days"),
    ).orderBy("year", "month_num", "city_name")


def fleet_capacity(latest: DataFrame) -> DataFrame:
    """Capacity per fuel, largest first, with its percent of the fleet; fuels without capacity are left out."""
    fuels = latest.groupBy("fuel_type").agg(exact_sum("net_summer_capacity_mw").alias("total_mw"))
    shared = ordered.share_of_total(fuels, "total_mw", "share_pct")
    return shared.filter(F.col("total_mw") > 0).orderBy(F.desc("total_mw"), "fuel_type")
