"""Staging models: one cleaned row per raw row (retail sales are pivoted)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import calendar, energy, field, grid, weather
from ..functions.core import exact_avg, exact_sum
from ..operators.filters import except_value, with_constants
from ..operators.reshape import pivot_max


def daily_demand(hourly: DataFrame, respondent: str = "PSCO", respondent_name: str = "Public Service Company of Colorado (Xcel Energy)") -> DataFrame:
    """Hours (``ts``, ``demand_mwh``) to one row per day. An all-NULL day has NULL sums."""
    daily = hourly.groupBy(F.to_date("ts").alias("date")).agg(
        F.bround(exact_sum("demand_mwh"), 1).alias("total_demand_mwh"),
        F.bround(F.max("demand_mwh"), 1).alias("peak_demand_mwh"),
        F.bround(exact_avg("demand_mwh"), 1).alias("avg_demand_mwh"),
        F.bround(F.min("demand_mwh"), 1).alias("min_demand_mwh"),
        F.count("demand_mwh").cast("int").alias("hours_reported"),
    )
    daily = daily.withColumns(
        {
            "load_tier": energy.load_tier("peak_demand_mwh"),
            "day_of_week": calendar.day_name("date"),
            "is_weekend": calendar.is_weekend("date"),
            "month": F.month("date"),
            "year": F.year("date"),
        }
    )
    return with_constants(daily, {"respondent": respondent, "respondent_name": respondent_name})


def demand(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("date", "demand_date").withColumns(
        {
            "daily_demand_swing_mwh": energy.demand_swing("peak_demand_mwh", "min_demand_mwh"),
            "is_critical_peak": energy.critical_peak("load_tier"),
            "is_high_load": energy.high_load("load_tier"),
            "season": calendar.season("month", null_to_fall=True),
        }
    )


def generators(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "capacity_efficiency_pct": energy.capacity_efficiency("net_summer_capacity_mw", "nameplate_capacity_mw"),
            "is_clean_energy": energy.clean_energy("fuel_type"),
            "is_dispatchable": energy.dispatchable("fuel_type"),
            "generator_size_tier": energy.generator_size_tier("net_summer_capacity_mw"),
            "fuel_category": energy.fuel_category("fuel_type"),
        }
    )


def retail_sales(raw: DataFrame, metrics: tuple = ("customers", "revenue", "sales", "price")) -> DataFrame:
    """Long to wide. The aggregate sector is dropped before the shuffle, which also drops a NULL sector."""
    keys = ["period", "state_id", "state_name", "sector", "sector_name"]
    wide = pivot_max(except_value(raw, "sector", rules.ALL_SECTORS), keys, "data_type", "value", metrics)
    month = calendar.period_to_month("period")
    return (
        wide.withColumnsRenamed(
            {"revenue": "revenue_million_usd", "sales": "sales_million_kwh", "price": "price_cents_per_kwh"}
        )
        .withColumn("sale_month", month)
        .withColumns(
            {
                "sales_mwh": energy.sales_mwh("sales_million_kwh"),
                "revenue_usd": energy.revenue_usd("revenue_million_usd"),
                "price_usd_per_kwh": energy.price_usd("price_cents_per_kwh"),
                "revenue_per_customer_usd": energy.revenue_per_customer("revenue_million_usd", "customers"),
                "year": F.year("sale_month"),
                "month": F.month("sale_month"),
                "month_name": calendar.month_short("sale_month"),
                "season": calendar.season(F.month("sale_month"), null_to_fall=True),
            }
        )
        .drop("period")
    )


def grid_nodes(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "criticality_tier": grid.criticality_tier("betweenness_centrality"),
            "voltage_class": grid.voltage_class("voltage_kv"),
            "is_major_hub": grid.major_hub("degree_centrality"),
        }
    )


def grid_edges(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "capacity_tier": grid.line_capacity_tier("capacity_mw"),
            "distance_bucket": grid.line_distance_bucket("distance_miles"),
        }
    )


def om_spend(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("city", "city_name").withColumns(
        {
            "month_name": calendar.month_long("spend_month"),
            "spend_tier": field.spend_tier("amount_usd"),
            "asset_category": field.asset_category("asset_type"),
        }
    )


def outages(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({"city": "city_name", "circuit": "circuit_id", "cause": "outage_cause"}).withColumns(
        {
            "duration_bucket": field.duration_bucket("duration_hours"),
            "outage_type": field.outage_type("outage_cause"),
            "customer_impact_tier": field.customer_impact_tier("customers_affected"),
        }
    )


def safety(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("city", "city_name").withColumns(
        {
            "observation_category": field.observation_category("observation_type"),
            "severity_score": field.severity_score("severity"),
            "closure_speed": field.closure_speed("days_to_close"),
        }
    )


def weather_days(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({"date": "weather_date", "city": "city_name"}).withColumns(
        {
            "temp_avg_f": weather.mean_temperature("temp_max_f", "temp_min_f"),
            "weather_description": weather.description("weather_code"),
        }
    )


def workforce(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({"city": "city_name", "risk_score": "weather_risk_score"}).withColumns(
        {
            "shift_type": field.shift_type("is_overtime"),
            "cost_tier": field.cost_tier("labor_cost"),
            "is_emergency_deployment": field.emergency_deployment("job_type"),
        }
    )
