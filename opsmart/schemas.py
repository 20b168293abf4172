"""Column types of the raw tables."""

from __future__ import annotations

# Raw table columns.
RAW_WEATHER = (
    "date date, city string, temp_max_f double, temp_min_f double, precipitation_inches double, "
    "wind_speed_max_mph double, weather_code double"
)
RAW_DEMAND = (
    "date date, respondent string, respondent_name string, total_demand_mwh double, peak_demand_mwh double, "
    "avg_demand_mwh double, min_demand_mwh double, hours_reported int, load_tier string, day_of_week string, "
    "is_weekend int, month int, year int, created_at timestamp_ntz"
)
RAW_GENERATORS = (
    "period date, state string, plant_name string, generator_id string, energy_source_code string, "
    "fuel_type string, technology string, net_summer_capacity_mw double, nameplate_capacity_mw double, "
    "latitude double, longitude double, created_at timestamp_ntz"
)
RAW_SALES = (
    "period string, state_id string, state_name string, sector string, sector_name string, data_type string, "
    "value double, unit string, created_at timestamp_ntz"
)
RAW_GRID_NODES = (
    "node_id string, node_type string, city string, voltage_kv bigint, capacity_mw bigint, latitude double, "
    "longitude double, degree_centrality double, betweenness_centrality double, created_at timestamp_ntz"
)
RAW_GRID_EDGES = (
    "source_node string, target_node string, distance_miles bigint, capacity_mw bigint, line_type string, "
    "created_at timestamp_ntz"
)
RAW_OUTAGES = (
    "outage_id int, outage_date date, city string, circuit string, cause string, duration_hours double, "
    "customers_affected int, weather_risk_score int"
)
RAW_SAFETY = (
    "obs_id int, obs_date date, city string, crew_id string, crew_type string, observation_type string, "
    "severity string, root_cause string, days_to_close int, weather_risk_score int, season string"
)
RAW_WORKFORCE = (
    "record_id int, work_date date, city string, crew_id string, crew_type string, job_type string, "
    "hours_worked double, is_overtime int, hourly_rate double, labor_cost double, risk_score int"
)
RAW_SPEND = (
    "spend_id int, spend_year int, spend_month int, city string, asset_type string, cost_category string, "
    "amount_usd double, avg_risk_score double"
)

RAW_TABLES = {
    "raw_weather": RAW_WEATHER,
    "raw_eia_demand": RAW_DEMAND,
    "raw_eia_generators": RAW_GENERATORS,
    "raw_eia_supply_disposition": RAW_SALES,
    "raw_grid_nodes": RAW_GRID_NODES,
    "raw_grid_edges": RAW_GRID_EDGES,
    "raw_outages": RAW_OUTAGES,
    "raw_safety": RAW_SAFETY,
    "raw_workforce": RAW_WORKFORCE,
    "raw_om_spend": RAW_SPEND,
}

# Landed API pages.
DEMAND_RECORD = "period string, value string"
GENERATOR_RECORD = (
    "period string, stateid string, stateName string, plantName string, generatorid string, "
    "energy_source_code string, technology string, `net-summer-capacity-mw` string, "
    "`nameplate-capacity-mw` string, latitude string, longitude string"
)
SALES_RECORD = (
    "period string, stateid string, stateName string, stateDescription string, sectorid string, sector string, "
    "sectorName string, typeName string, "
    "customers string, revenue string, sales string, price string, `customers-units` string, "
    "`revenue-units` string, `sales-units` string, `price-units` string"
)
DAILY_WEATHER_PAGE = (
    "daily struct<time: array<string>, temperature_2m_max: array<double>, temperature_2m_min: array<double>, "
    "precipitation_sum: array<double>, windspeed_10m_max: array<double>, weathercode: array<double>>"
)
DAILY_WEATHER = (
    "time string, temp_max_f double, temp_min_f double, precipitation_inches double, wind_speed_max_mph double, weather_code double"
)
