"""Boundary and NULL rows of every derived column."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsmart import rules
from opsmart.functions import calendar, core, energy, field, grid, weather


def one(values):
    return [(v,) for v in values]


@pytest.mark.parametrize(
    "make, values, expected",
    [
        (weather.freeze_risk, [32.0, 31.9, None], [0, 1, 0]),
        (weather.heat_alert, [95.0, 95.1, None], [0, 1, 0]),
        (weather.high_wind, [45.0, 45.1, None], [0, 1, 0]),
        (weather.heavy_precip, [0.5, 0.51, None], [0, 1, 0]),
        (weather.description, [0.0, 1.0, 3.0, 48.0, 67.0, 77.0, 82.0, 99.0, 100.0, None],
         ["Clear Sky", "Partly Cloudy", "Partly Cloudy", "Foggy", "Rainy", "Snowy", "Rain Showers", "Thunderstorm", "Unknown", "Unknown"]),
        (weather.risk_label, [0.0, 1.0, 2.0, 3.0, 4.0], ["Normal Operations", "Monitor", "Elevated Risk", "High Alert", "High Alert"]),
        (calendar.heating_degree_days, [65.0, 64.9, 70.0, None], [0.0, 0.1, 0.0, 0.0]),
        (calendar.cooling_degree_days, [65.0, 65.1, 60.0, None], [0.0, 0.1, 0.0, 0.0]),
        (energy.load_tier, [6500.0, 6499.9, 5500.0, 4500.0, 4499.9, float("nan"), None],
         ["Critical Peak", "High Load", "High Load", "Moderate Load", "Normal Load", "Normal Load", "Normal Load"]),
        (energy.generator_size_tier, [500.0, 499.9, 100.0, 10.0, 9.9, None],
         ["Utility Scale (500+ MW)", "Large (100-499 MW)", "Large (100-499 MW)", "Medium (10-99 MW)", "Small (< 10 MW)", "Small (< 10 MW)"]),
        (energy.price_tier, [15.0, 12.0, 9.0, 8.9, None], ["Premium Rate", "Standard Rate", "Discounted Rate", "Industrial Rate", "Industrial Rate"]),
        (energy.grid_dependency, [25.0, 10.0, 5.0, 4.9], ["Critical Dependency", "Significant Dependency", "Moderate Dependency", "Low Dependency"]),
        (energy.demand_pressure, [10642.0, 21284.0, 5321.0], [10.0, 20.0, 5.0]),
        (grid.criticality_tier, [0.5, 0.2, 0.05, 0.049], ["Critical", "Important", "Standard", "Peripheral"]),
        (grid.voltage_class, [345.0, 230.0, 115.0, 114.0], ["Extra High Voltage", "High Voltage", "Medium Voltage", "Low Voltage"]),
        (grid.major_hub, [0.3, 0.29, None], [1, 0, 0]),
        (grid.line_capacity_tier, [1000.0, 500.0, 499.0], ["High Capacity", "Medium Capacity", "Low Capacity"]),
        (grid.line_distance_bucket, [10.0, 40.0, 41.0], ["Local", "Regional", "Interstate"]),
        (field.duration_bucket, [0.9, 1.0, 4.0, 8.0, 16.0, None],
         ["Under 1 Hour", "1-4 Hours", "4-8 Hours", "8-16 Hours", "Over 16 Hours", "Over 16 Hours"]),
        (field.customer_impact_tier, [499.0, 500.0, 2000.0, 5000.0, None], ["Low", "Medium", "High", "Critical", "Critical"]),
        (field.closure_speed, [5.0, 14.0, 30.0, 31.0, None], ["Fast", "Normal", "Slow", "Overdue", "Overdue"]),
        (field.spend_tier, [4999.0, 5000.0, 15000.0, 30000.0, None], ["Low", "Medium", "High", "Very High", "Very High"]),
        (field.cost_tier, [399.0, 400.0, 700.0, 1000.0], ["Low Cost", "Medium Cost", "High Cost", "Premium Cost"]),
        (field.shift_length_bucket, [12.0, 8.0, 7.9], ["Extended Shift", "Full Shift", "Partial Shift"]),
        (field.high_spend, [20000.0, 20000.01], [0, 1]),
        (field.city_risk_label, [1.5, 1.0, 0.5, 0.4], ["High Risk", "Elevated Risk", "Moderate Risk", "Low Risk"]),
        (field.risk_multiplier, [0.0, 4.0], [1.0, 2.0]),
        (field.expected_outages, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0], [1.5, 3.0, 6.0, 10.0, 15.0, None]),
        (field.expected_observations, [0.0, 1.0, 2.0, 3.0, 4.0], [1, 2, 4, 6, 9]),
        (energy.sales_mwh, [1.2345], [1235.0]),
        (energy.revenue_usd, [1.5], [1500000.0]),
        (energy.price_usd, [12.345], [0.1235]),
    ],
)
def test_number_rules(column, make, values, expected):
    assert column(one(values), "v double", make("v")) == expected


@pytest.mark.parametrize(
    "make, values, expected",
    [
        (field.outage_type, ["Planned Outage", "PLANNED x", "Unplanned", "Wind Damage", None], ["Planned", "Planned", "Planned", "Unplanned", "Unplanned"]),
        (field.weather_driven, ["Pipe Burst", "Equipment Failure", None], [1, 0, 0]),
        (field.observation_category, ["Positive Observation", "Incident", None], ["Positive", "Negative", "Negative"]),
        (field.severity_score, ["Low", "Medium", "High", "Critical", "x", None], [1, 2, 3, 4, 0, 0]),
        (field.incident, ["Incident", "Near Miss", "Property Damage", None], [1, 1, 0, 0]),
        (field.emergency_deployment, ["EMERGENCY Response", "Storm Restoration", "Damage", None], [1, 1, 0, 0]),
        (field.asset_category, ["Substation", "Smart Meter", None], ["Infrastructure", "Operational", "Operational"]),
        (field.clean_place, ["Fort_Collins"], ["Fort Collins"]),
        (energy.fuel_type, ["NG", "LIG", None], ["Natural Gas", "LIG", None]),
        (energy.fuel_category, ["Wind", "Battery Storage", "Other Gas", "Bituminous Coal", "Diesel", "LIG", None],
         ["Renewables", "Storage", "Gas", "Coal", "Oil", "Other", "Other"]),
        (energy.clean_energy, ["Battery Storage", "Nuclear", None], [1, 0, 0]),
        (energy.dispatchable, ["Coal", "Bituminous Coal", "Subbituminous Coal"], [1, 0, 0]),
        (energy.critical_peak, ["Critical Peak", "High Load", None], [1, 0, 0]),
        (energy.high_load, ["Critical Peak", "High Load", "Normal Load"], [1, 1, 0]),
        (core.to_number, ["12.5", "", "x", None, "NaN", "Infinity", "-inf"], [12.5] + [None] * 6),
        (core.text_or_empty, ["a", None], ["a", ""]),
        (calendar.period_to_month, ["2024-03", "2024", None], [dt.date(2024, 3, 1), None, None]),
    ],
)
def test_text_rules(column, make, values, expected):
    assert column(one(values), "v string", make("v")) == expected


def test_seasons(column):
    months = one([*range(1, 13), None])
    named = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    assert column(months, "m int", calendar.season("m")) == [*named, None]
    assert column(months, "m int", calendar.season("m", null_to_fall=True)) == [*named, "Fall"]


def test_calendar(column):
    days = one([dt.date(2026, 6, 21), dt.date(2026, 6, 22), dt.date(2021, 1, 3)])
    assert column(days, "d date", calendar.day_of_week("d")) == [0, 1, 0]
    assert column(days, "d date", calendar.is_weekend("d")) == [1, 0, 1]
    assert column(days, "d date", calendar.day_name("d"))[0] == "Sunday"
    assert column(days, "d date", calendar.iso_week("d")) == [25, 26, 53]
    assert column(days, "d date", calendar.month_short("d"))[0] == "Jun"
    assert column(one([1, 12, 13, None]), "m int", calendar.month_long("m")) == ["January", "December", None, None]
    latest = F.lit(dt.date(2026, 6, 1))
    assert column(one([dt.date(2025, 6, 1), dt.date(2025, 5, 1)]), "d date", calendar.within_last_months("d", latest)) == [1, 0]


def test_outage_severity(column):
    rows = [(499.0, 1.9), (500.0, 1.9), (499.0, 2.0), (1999.0, 4.0), (7999.0, 15.9), (8000.0, 1.0), (None, 1.0)]
    assert column(rows, "c double, h double", field.outage_severity("c", "h")) == [1, 2, 2, 3, 4, 5, 5]


def test_overdue(column):
    rows = [("Critical", 14), ("Critical", 15), ("High", 30), ("High", 31), ("Low", 99)]
    assert column(rows, "s string, d int", field.overdue("s", "d")) == [0, 1, 0, 1, 0]


def test_ratios(column):
    assert column([(100.0, 0.0), (100.0, 4.0), (100.0, None)], "a double, r double", field.cost_per_risk_point("a", "r")) == [100.0, 25.0, 100.0]
    assert column([(5.0, 0.0), (5.0, 10.0), (None, 10.0)], "n double, p double", energy.capacity_efficiency("n", "p")) == [None, 50.0, None]
    assert column([(None, 3), (90.0, 3), (None, None), (10.0, 0)], "l double, o int", field.labor_cost_per_outage("l", "o")) == [None, 30.0, 0.0, 0.0]
    assert column([(1, 3), (None, 3), (1, 0)], "i int, c int", field.incident_rate_per_crew("i", "c")) == [0.3333, 0.0, 0.0]
    assert column([(50, 0), (50, 200), (None, 10)], "l int, n int", grid.throughput_ratio("l", "n")) == [None, 25.0, 0.0]
    assert column([(10.0, 0.0), (10.0, 4.0)], "p double, d double", energy.mwh_per_degree("p", "d")) == [None, 2.5]


def test_scores(column):
    assert column([(4, 5, 4.0), (1, None, None)], "r int, m int, a double", field.operational_stress("r", "m", "a")) == [15.0, 1.5]
    assert column([(4, 4)], "s int, r int", field.safety_risk_index("s", "r")) == [20.0]
    assert column([(0.4286, 0.7253)], "d double, b double", grid.importance_score("d", "b")) == [57.7]
    assert column([(100, 1.5)], "c int, h double", field.customer_minutes_lost("c", "h")) == [9000.0]
    assert column([(1, 300.0, 8.0, 20.0), (0, 300.0, 8.0, 20.0)], "o int, l double, h double, r double", field.overtime_premium("o", "l", "h", "r")) == [140.0, 0.0]
    assert column([(10.0, 50.0, 1), (10.0, 50.0, 0)], "h double, r double, o int", field.labor_cost("h", "r", "o")) == [750.0, 500.0]
    assert column([("Denver", 7), ("Pueblo", 123)], "c string, n int", field.crew_id("c", "n")) == ["DE-CREW-07", "PU-CREW-123"]
    assert column([("Denver", 4), ("Pueblo", 0), ("x", 0)], "c string, r int", field.required_crews("c", "r")) == [16, 2, None]
    assert column([(180.0, "Transformer", "Labor", 0.0), (1.0, "x", "Labor", 0.0)], "a double, t string, c string, r double", field.base_amount("a", "t", "c", "r")) == [100.0, None]


def test_operational_condition(column):
    rows = [(85.0, 5500.0, 0, 0), (20.0, 5500.0, 0, 0), (50.0, 7000.0, 1, 1), (50.0, 5600.0, 0, 1), (90.0, 5499.0, 0, 0), (None, 9000.0, 0, 0)]
    got = column(rows, "t double, p double, c int, h int", energy.operational_condition("t", "p", "c", "h"))
    assert got == ["Heat Wave Stress", "Cold Snap Stress", "Grid Critical", "High Demand", "Normal Operations", "Normal Operations"]


def test_regime_precedence(column):
    schema = "is_high_wind int, is_freeze_risk int, is_heavy_precip int, is_heat_alert int"
    rows = [(1, 1, 1, 1), (0, 0, 1, 1), (0, 0, 0, 0)]
    assert column(rows, schema, weather.regime(rules.OUTAGE_REGIME_ORDER)) == ["wind", "precip", "none"]
    assert column(rows, schema, weather.regime(rules.SAFETY_REGIME_ORDER)) == ["wind", "heat", "none"]


def test_sector_labels(column):
    rows = [("RES", "a"), ("TRA", "b"), ("ZZZ", "c")]
    assert column(rows, "s string, n string", energy.sector_display("s", "n")) == ["Residential 🏠", "Transportation 🚗", "c"]


def test_strict_greatest_and_names(column):
    assert column([(1.0, 0.0), (None, 0.0), (-1.0, 0.0)], "a double, b double", core.strict_greatest(F.col("a"), F.col("b"))) == [1.0, None, 0.0]
    assert core.first_present(["b", "c"], ["a", "c"]) == "c"
    assert core.first_containing(["x", "plantName"], ["plantname"]) == "plantName"
    assert column([(1,)], "a int", core.first_present_col(["a"], ["zz"], "none")) == ["none"]


def test_exact_sum_ignores_order(spark):
    rows = [(0.1,)] * 1000 + [(1e12,)] + [(-1e12,)]
    assert spark.createDataFrame(rows, "v double").agg(core.exact_sum("v").alias("s")).first()["s"] == 100.0
    empty = spark.createDataFrame([(None,)], "v double").agg(core.exact_avg("v").alias("a"), core.exact_sum("v").alias("s")).first()
    assert (empty["a"], empty["s"]) == (None, None)


def test_sums_keep_all_digits(spark):
    def of(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return tuple(df.agg(core.exact_sum("v"), core.exact_avg("v")).first())

    assert of(0.004, 0.004, 0.004) == (0.012, 0.004)
    assert of(2e16, 2e16) == (4e16, 2e16)
    assert of(5000.0, float("nan"), 6000.0, None, float("inf")) == (11000.0, 5500.0)
    assert of(1e-15, 1e-15) == (2e-15, 1e-15) and of(1e30, 1e30) == (2e30, 1e30)
    assert of(9e25, 9e25) == (1.8e26, 9e25) and of(None) == (None, None)
