"""Column tests of the marts and the report over them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from ..operators.quality import accepted_values, not_null, run_tests, unique

# Accepted labels of the tested columns.
SEASON_NAMES = ["Winter", "Spring", "Summer", "Fall"]
CITY_NAMES = ["Boulder", "Colorado_Springs", "Denver", "Fort_Collins", "Pueblo"]
RISK_LABELS = ["Normal Operations", "Monitor", "Elevated Risk", "High Alert"]
LOAD_TIERS = ["Critical Peak", "High Load", "Moderate Load", "Normal Load"]
CONDITIONS = ["Heat Wave Stress", "Cold Snap Stress", "Grid Critical", "High Demand", "Normal Operations"]
DEPENDENCIES = ["Critical Dependency", "Significant Dependency", "Moderate Dependency", "Low Dependency"]
SECTORS = ["RES", "COM", "IND", "TRA", "OTH"]
PRICE_TIERS = ["Premium Rate", "Standard Rate", "Discounted Rate", "Industrial Rate"]

MART_TESTS = {
    "mart_weather_operations": [
        *not_null("weather_date", "city_name", "temp_max_f", "temp_min_f", "temp_avg_f"),
        *not_null("heating_degree_days", "cooling_degree_days", "ops_risk_score", "ops_risk_label", "season"),
        *accepted_values("city_name", CITY_NAMES),
        *accepted_values("ops_risk_score", [0, 1, 2, 3, 4]),
        *accepted_values("ops_risk_label", RISK_LABELS),
        *accepted_values("season", SEASON_NAMES),
    ],
    "mart_eia_weather": [
        *not_null("demand_date", "respondent", "total_demand_mwh", "peak_demand_mwh", "load_tier"),
        *not_null("season", "demand_pressure_score", "operational_condition"),
        *unique("demand_date"),
        *accepted_values("respondent", ["PSCO"]),
        *accepted_values("load_tier", LOAD_TIERS),
        *accepted_values("season", SEASON_NAMES),
        *accepted_values("operational_condition", CONDITIONS),
    ],
    "mart_generator_mix": [
        *not_null("fuel_type", "total_net_capacity_mw", "fleet_share_pct", "is_clean_energy", "grid_dependency_label"),
        *unique("fuel_type"),
        *accepted_values("is_clean_energy", [0, 1]),
        *accepted_values("grid_dependency_label", DEPENDENCIES),
    ],
    "mart_eia_sales_by_sector": [
        *not_null("sale_month", "sector", "sector_name", "season", "price_tier"),
        *not_null("sales_mwh", "price_cents_per_kwh", severity="warn"),
        *accepted_values("sector", SECTORS),
        *accepted_values("season", SEASON_NAMES),
        *accepted_values("price_tier", PRICE_TIERS),
    ],
}


def report(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Test results of all given marts in one frame."""
    return reduce(DataFrame.unionByName, [run_tests(df, name, MART_TESTS[name]) for name, df in marts.items()])
