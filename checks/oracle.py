"""SQL for the registered queries, written for DuckDB over the given tables.

Ladders, lists and lookup tables are taken from the fixed values, whose effect
is pinned by hand-written rows in the tests. Everything else (joins, grouping,
rounding, windows, recursion) is stated here on its own.
"""

from __future__ import annotations

from opsmart import rules
from opsmart.plans.contracts import MART_TESTS

from . import raw_frames as raw
from .queries import REGION_CREWS


# Small text helpers.
def rnd(x: str, n: int) -> str:
    """Round half away from zero on the decimal text of a double, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def even(x: str, n: int) -> str:
    return f"CAST(round_even(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def exact(x: str) -> str:
    """The decimal text of a number with twelve digits, far more than any measurement has, so sums ignore order."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12))"


def total(x: str) -> str:
    return f"CAST(sum({exact(x)}) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / nullif(count({x}), 0))"


def text(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def ladder(x: str, steps, other) -> str:
    arms = " ".join(f"WHEN {x} {'=' if op == '==' else op} {limit} THEN {text(label)}" for op, limit, label in steps)
    return f"CASE {arms} ELSE {text(other)} END"


def pick(x: str, table: dict, other: str = "NULL") -> str:
    arms = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in table.items())
    return f"CASE {x} {arms} ELSE {other} END"


def member(x: str, values) -> str:
    return f"{x} IN ({', '.join(text(v) for v in values)})"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def season(month: str, else_fall: bool = False) -> str:
    named = rules.SEASONS[:3] if else_fall else rules.SEASONS
    arms = " ".join(f"WHEN {member(month, months)} THEN '{name}'" for name, months in named)
    return f"CASE {arms} ELSE {text('Fall') if else_fall else 'NULL'} END"


def year(x: str) -> str:
    return f"CAST(year({x}) AS INTEGER)"


def month(x: str) -> str:
    return f"CAST(month({x}) AS INTEGER)"


def week(x: str) -> str:
    return f"CAST(weekofyear({x}) AS INTEGER)"


def crew(city: str, number: str) -> str:
    return f"upper(substr({city}, 1, 2)) || '-CREW-' || lpad(CAST({number} AS VARCHAR), 2, '0')"


# Named steps. A query lists the steps it needs in order.
STEP: dict[str, str] = {}

STEP["place"] = "SELECT n_nationkey AS nk, replace(r_name, ' ', '_') AS city FROM nation JOIN region ON n_regionkey = r_regionkey"
STEP["ord"] = """SELECT o.*, CAST(o_orderdate AS DATE) AS day, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS digit,
    c_acctbal, c_mktsegment, city
    FROM orders o JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = nk"""
STEP["raw_weather"] = f"""SELECT day AS date, city, {rnd('max(o_totalprice) / 4500', 1)} AS temp_max_f,
    {rnd('min(o_totalprice) / 4500', 1)} AS temp_min_f,
    {rnd('nullif(max(o_totalprice) - min(o_totalprice), 0) / 400000', 2)} AS precipitation_inches,
    {rnd('max(c_acctbal) / 200', 1)} AS wind_speed_max_mph,
    CAST(min(digit) * max(digit) * 4 - 4 AS DOUBLE) AS weather_code FROM ord GROUP BY day, city"""
STEP["days"] = f"""SELECT date AS weather_date, city AS city_name, temp_max_f, temp_min_f, precipitation_inches,
    wind_speed_max_mph, weather_code, {rnd('(temp_max_f + temp_min_f) / 2', 1)} AS temp_avg_f,
    {ladder('weather_code', rules.WEATHER_DESCRIPTION, rules.WEATHER_DESCRIPTION_ELSE)} AS weather_description
    FROM raw_weather"""
STEP["flags"] = f"""SELECT weather_date, city_name, temp_max_f, temp_min_f, precipitation_inches, wind_speed_max_mph,
    temp_avg_f, weather_description,
    CASE WHEN temp_avg_f < 65 THEN {rnd('65 - temp_avg_f', 1)} ELSE 0.0::DOUBLE END AS heating_degree_days,
    CASE WHEN temp_avg_f > 65 THEN {rnd('temp_avg_f - 65', 1)} ELSE 0.0::DOUBLE END AS cooling_degree_days,
    {flag('temp_min_f < 32')} AS is_freeze_risk, {flag('temp_max_f > 95')} AS is_heat_alert,
    {flag('wind_speed_max_mph > 45')} AS is_high_wind, {flag('precipitation_inches > 0.5')} AS is_heavy_precip,
    {season('month(weather_date)')} AS season, {year('weather_date')} AS year, {month('weather_date')} AS month_num,
    {week('weather_date')} AS week_num FROM days"""
STEP["scored"] = "SELECT *, CAST(is_freeze_risk + is_heat_alert + is_high_wind + is_heavy_precip AS INTEGER) AS ops_risk_score FROM flags"
STEP["wx"] = f"SELECT *, {ladder('ops_risk_score', rules.OPS_RISK_LABEL, rules.OPS_RISK_LABEL_ELSE)} AS ops_risk_label FROM scored"
WEATHER = ["place", "ord", "raw_weather", "days", "flags", "scored", "wx"]

STEP["raw_out"] = f"""SELECT l_orderkey AS outage_id, CAST(l_shipdate AS DATE) AS outage_date, city AS city_name,
    'C' || l_suppkey AS circuit_id, {pick('l_returnflag || l_linestatus', raw.CAUSE_BY_FLAGS)} AS outage_cause,
    l_quantity / 2 AS duration_hours, CAST(floor(l_extendedprice / 10) AS INTEGER) AS customers_affected,
    CAST(floor(l_discount * 40) AS INTEGER) AS weather_risk_score
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN place ON s_nationkey = nk"""
_severity = " ".join(f"WHEN customers_affected < {c} AND duration_hours < {h} THEN {k}" for c, h, k in rules.OUTAGE_SEVERITY)
STEP["out"] = f"""SELECT *, {ladder('duration_hours', rules.DURATION_BUCKET, rules.DURATION_BUCKET_ELSE)} AS duration_bucket,
    CASE WHEN lower(outage_cause) LIKE '%planned%' THEN 'Planned' ELSE 'Unplanned' END AS outage_type,
    {ladder('customers_affected', rules.CUSTOMER_IMPACT_TIER, rules.CUSTOMER_IMPACT_TIER_ELSE)} AS customer_impact_tier,
    {rnd('customers_affected * duration_hours * 60', 0)} AS customer_minutes_lost,
    CASE {_severity} ELSE {rules.OUTAGE_SEVERITY_ELSE} END AS outage_severity_score,
    {flag(member('outage_cause', rules.WEATHER_CAUSES))} AS is_weather_driven,
    {year('outage_date')} AS year, {month('outage_date')} AS month_num,
    CAST(dayofweek(outage_date) AS INTEGER) AS day_of_week FROM raw_out"""

STEP["raw_wf"] = f"""SELECT o_orderkey AS record_id, day AS work_date, city AS city_name, {crew('city', 'digit')} AS crew_id,
    {pick('c_mktsegment', raw.CREW_BY_SEGMENT)} AS crew_type, {pick('digit', raw.JOB_BY_DIGIT)} AS job_type,
    {rnd('o_totalprice / 50000 + 4', 1)} AS hours_worked, {rnd('abs(c_acctbal) / 250 + 45', 2)} AS hourly_rate,
    CAST(digit - 1 AS INTEGER) AS weather_risk_score FROM ord"""
STEP["paid"] = f"""SELECT *, {flag('hours_worked > 8')} AS is_overtime,
    {rnd('hours_worked * hourly_rate * CASE WHEN hours_worked > 8 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END', 2)} AS labor_cost FROM raw_wf"""
STEP["wf"] = f"""SELECT *, CASE WHEN is_overtime = 1 THEN 'Overtime' ELSE 'Regular' END AS shift_type,
    {ladder('labor_cost', rules.COST_TIER, rules.COST_TIER_ELSE)} AS cost_tier,
    {flag("regexp_matches(lower(job_type), 'emergency|storm|restoration')")} AS is_emergency_deployment,
    CASE WHEN is_overtime = 1 THEN {rnd('labor_cost - hours_worked * hourly_rate', 2)} ELSE 0.0::DOUBLE END AS overtime_premium_cost,
    {ladder('hours_worked', rules.SHIFT_LENGTH_BUCKET, rules.SHIFT_LENGTH_BUCKET_ELSE)} AS shift_length_bucket,
    {year('work_date')} AS year, {month('work_date')} AS month_num, {week('work_date')} AS week_num FROM paid"""

STEP["raw_saf"] = f"""SELECT o_orderkey AS obs_id, day AS obs_date, city AS city_name, {crew('city', 'digit')} AS crew_id,
    {pick('c_mktsegment', raw.CREW_BY_SEGMENT)} AS crew_type, {pick('digit', raw.OBSERVATION_BY_DIGIT)} AS observation_type,
    {pick('c_mktsegment', raw.SEVERITY_BY_SEGMENT)} AS severity, {pick('o_orderstatus', raw.ROOT_CAUSE_BY_STATUS)} AS root_cause,
    CAST(floor(o_totalprice / 10000) AS INTEGER) AS days_to_close, CAST(digit - 1 AS INTEGER) AS weather_risk_score,
    {season('month(day)')} AS season, {pick(pick('c_mktsegment', raw.SEVERITY_BY_SEGMENT), rules.SEVERITY_SCORE, '0')} AS severity_score
    FROM ord"""
STEP["saf"] = f"""SELECT *, CASE WHEN observation_type = 'Positive Observation' THEN 'Positive' ELSE 'Negative' END AS observation_category,
    {ladder('days_to_close', rules.CLOSURE_SPEED, rules.CLOSURE_SPEED_ELSE)} AS closure_speed,
    CAST(severity_score * (weather_risk_score + 1) AS DOUBLE) AS safety_risk_index,
    {flag("(severity = 'Critical' AND days_to_close > 14) OR (severity = 'High' AND days_to_close > 30)")} AS is_overdue,
    {flag(member('observation_type', rules.INCIDENT_TYPES))} AS is_incident,
    {year('obs_date')} AS year, {month('obs_date')} AS month_num FROM raw_saf"""

STEP["out_day"] = f"""SELECT outage_date AS day, city_name, count(*) AS n_out, CAST(sum(customers_affected) AS BIGINT) AS customers,
    {total('customer_minutes_lost')} AS cml, {rnd(mean('duration_hours'), 2)} AS hours, max(outage_severity_score) AS worst,
    CAST(sum(is_weather_driven) AS BIGINT) AS weather_n, count(*) FILTER (outage_type = 'Unplanned') AS unplanned
    FROM out GROUP BY ALL"""
STEP["wf_day"] = f"""SELECT work_date AS day, city_name, count(*) AS crews, {total('hours_worked')} AS hours,
    {total('labor_cost')} AS labor, {total('overtime_premium_cost')} AS overtime,
    CAST(sum(is_emergency_deployment) AS BIGINT) AS emergency, CAST(sum(is_overtime) AS BIGINT) AS ot_shifts
    FROM wf GROUP BY ALL"""
STEP["saf_day"] = f"""SELECT obs_date AS day, city_name, count(*) AS n_obs, CAST(sum(is_incident) AS BIGINT) AS incidents,
    {rnd(mean('severity_score'), 2)} AS severity, max(safety_risk_index) AS risk, CAST(sum(is_overdue) AS BIGINT) AS late,
    count(*) FILTER (observation_category = 'Positive') AS positive FROM saf GROUP BY ALL"""
STEP["daily"] = f"""SELECT weather_date AS summary_date, wx.city_name, season, year, month_num, week_num, temp_max_f, temp_min_f,
    temp_avg_f, precipitation_inches, wind_speed_max_mph, weather_description, heating_degree_days, cooling_degree_days,
    ops_risk_score, ops_risk_label,
    ifnull(n_out, 0) AS total_outages, ifnull(customers, 0) AS total_customers_affected,
    ifnull(cml, 0) AS total_customer_minutes_lost, ifnull(out_day.hours, 0) AS avg_outage_duration_hrs,
    ifnull(worst, 0) AS max_outage_severity, ifnull(weather_n, 0) AS weather_driven_outages, ifnull(unplanned, 0) AS unplanned_outages,
    ifnull(crews, 0) AS total_crews_deployed, ifnull(wf_day.hours, 0) AS total_hours_worked, ifnull(labor, 0) AS total_labor_cost,
    ifnull(overtime, 0) AS total_overtime_cost, ifnull(emergency, 0) AS emergency_deployments, ifnull(ot_shifts, 0) AS overtime_shifts,
    ifnull(n_obs, 0) AS total_observations, ifnull(incidents, 0) AS total_incidents, ifnull(severity, 0) AS avg_severity_score,
    ifnull(risk, 0) AS max_safety_risk_index, ifnull(late, 0) AS overdue_closures, ifnull(positive, 0) AS positive_observations,
    CASE WHEN n_out > 0 THEN {rnd('labor / n_out', 2)} ELSE 0.0::DOUBLE END AS labor_cost_per_outage,
    CASE WHEN crews > 0 THEN {rnd('ifnull(incidents, 0) / crews', 4)} ELSE 0.0::DOUBLE END AS incident_rate_per_crew,
    {rnd('ops_risk_score * 1.5::DOUBLE + ifnull(worst, 0) + ifnull(severity, 0)', 1)} AS operational_stress_score
    FROM wx LEFT JOIN out_day ON out_day.day = weather_date AND out_day.city_name = wx.city_name
    LEFT JOIN wf_day ON wf_day.day = weather_date AND wf_day.city_name = wx.city_name
    LEFT JOIN saf_day ON saf_day.day = weather_date AND saf_day.city_name = wx.city_name"""
OUT = ["raw_out", "out"]
WF = ["raw_wf", "paid", "wf"]
SAF = ["raw_saf", "saf"]
DAILY = [*WEATHER, *OUT, *WF, *SAF, "out_day", "wf_day", "saf_day", "daily"]

STEP["city"] = f"""SELECT city_name, count(*) AS total_days, {rnd(mean('total_outages'), 2)} AS avg_daily_outages,
    {total('total_outages')} AS total_outages, {rnd(mean('total_customer_minutes_lost'), 0)} AS avg_customer_minutes_lost,
    {total('total_customer_minutes_lost')} AS total_customer_minutes_lost, {rnd(mean('total_crews_deployed'), 2)} AS avg_crews_per_day,
    {total('total_labor_cost')} AS total_labor_cost, {rnd(mean('operational_stress_score'), 3)} AS avg_stress_score,
    max(operational_stress_score) AS peak_stress_score, {rnd(mean('temp_avg_f'), 1)} AS avg_temperature_f,
    {rnd(mean('heating_degree_days'), 1)} AS avg_heating_degree_days, {rnd(mean('cooling_degree_days'), 1)} AS avg_cooling_degree_days
    FROM daily GROUP BY city_name"""
STEP["ranked"] = f"""SELECT *, rank() OVER (ORDER BY avg_stress_score DESC NULLS LAST) AS stress_rank,
    {ladder('avg_stress_score', rules.CITY_RISK_LABEL, rules.CITY_RISK_LABEL_ELSE)} AS risk_label FROM city"""

STEP["sp"] = f"""SELECT o_orderkey AS spend_id, {year('day')} AS spend_year, {month('day')} AS spend_month, city,
    {pick('c_mktsegment', raw.ASSET_BY_SEGMENT)} AS asset_type, {pick('o_orderstatus', raw.CATEGORY_BY_STATUS)} AS cost_category,
    {rnd('o_totalprice / 10', 2)} AS amount_usd, CAST(5 - digit AS DOUBLE) AS avg_risk_score FROM ord"""
SPEND = ["place", "ord", "sp"]
STEP["spend_mart"] = f"""SELECT * RENAME (city AS city_name), monthname(make_date(2000, spend_month, 1)) AS month_name,
    {ladder('amount_usd', rules.SPEND_TIER, rules.SPEND_TIER_ELSE)} AS spend_tier,
    CASE WHEN {member('asset_type', rules.INFRASTRUCTURE_ASSETS)} THEN 'Infrastructure' ELSE 'Operational' END AS asset_category,
    CASE WHEN avg_risk_score > 0 THEN {rnd('amount_usd / avg_risk_score', 2)} ELSE amount_usd END AS cost_per_risk_point,
    {season('spend_month')} AS season, {flag('amount_usd > 20000')} AS is_high_spend FROM sp"""

STEP["meter"] = "SELECT CAST(ts AS DATE) AS date, value * 15 AS mwh FROM events"
STEP["raw_dem"] = f"""SELECT date, {even(total('mwh'), 1)} AS total_demand_mwh, {even('max(mwh)', 1)} AS peak_demand_mwh,
    {even(mean('mwh'), 1)} AS avg_demand_mwh, {even('min(mwh)', 1)} AS min_demand_mwh, CAST(count(mwh) AS INTEGER) AS hours_reported
    FROM meter GROUP BY date"""
STEP["tiered"] = f"SELECT *, {ladder('peak_demand_mwh', rules.LOAD_TIER, rules.LOAD_TIER_ELSE)} AS load_tier FROM raw_dem"
STEP["dem"] = f"""SELECT date AS demand_date, * EXCLUDE (date), dayname(date) AS day_of_week, {flag('dayofweek(date) IN (0, 6)')} AS is_weekend,
    {month('date')} AS month, {year('date')} AS year, 'PSCO' AS respondent,
    'Public Service Company of Colorado (Xcel Energy)' AS respondent_name,
    {rnd('peak_demand_mwh - min_demand_mwh', 1)} AS daily_demand_swing_mwh, {flag("load_tier = 'Critical Peak'")} AS is_critical_peak,
    {flag("load_tier IN ('Critical Peak', 'High Load')")} AS is_high_load, {season('month(date)', True)} AS season FROM tiered"""
DEMAND = ["meter", "raw_dem", "tiered", "dem"]

STEP["gen"] = f"""SELECT CAST(DATE '2024-01-01' + to_months(CAST((p_size - 1) // 5 AS INTEGER)) AS DATE) AS period, 'CO' AS state,
    p_brand AS plant_name, CAST(p_partkey AS VARCHAR) AS generator_id, {pick("split_part(p_name, ' ', 1)", raw.FUEL_BY_WORD)} AS energy_source_code,
    {pick(pick("split_part(p_name, ' ', 1)", raw.FUEL_BY_WORD), rules.FUEL_BY_CODE, pick("split_part(p_name, ' ', 1)", raw.FUEL_BY_WORD))} AS fuel_type,
    p_type AS technology, {rnd('(p_retailprice - 900) * 7', 1)} AS net_summer_capacity_mw,
    CAST((p_size - 1) * 15 AS DOUBLE) AS nameplate_capacity_mw FROM part"""
_categories = " ".join(f"WHEN {member('fuel_type', fuels)} THEN '{name}'" for name, fuels in rules.FUEL_CATEGORIES)
STEP["fleet"] = f"""SELECT *, CASE WHEN nameplate_capacity_mw > 0 THEN {rnd('net_summer_capacity_mw / nameplate_capacity_mw * 100', 1)} END AS capacity_efficiency_pct,
    {flag(member('fuel_type', rules.CLEAN_FUELS))} AS is_clean_energy, {flag(member('fuel_type', rules.DISPATCHABLE_FUELS))} AS is_dispatchable,
    {ladder('net_summer_capacity_mw', rules.GENERATOR_SIZE_TIER, rules.GENERATOR_SIZE_TIER_ELSE)} AS generator_size_tier,
    CASE {_categories} ELSE 'Other' END AS fuel_category FROM gen"""
STEP["fuels"] = f"""SELECT fuel_category, fuel_type, state, period, count(*) AS generator_count, {total('net_summer_capacity_mw')} AS net,
    {rnd(total('nameplate_capacity_mw'), 0)} AS total_nameplate_capacity_mw, {rnd(mean('capacity_efficiency_pct'), 1)} AS avg_efficiency_pct,
    {rnd(mean('net_summer_capacity_mw'), 1)} AS avg_generator_size_mw, max(net_summer_capacity_mw) AS largest_generator_mw,
    max(is_clean_energy) AS is_clean_energy, max(is_dispatchable) AS is_dispatchable FROM fleet GROUP BY ALL"""
STEP["shares"] = f"""SELECT * EXCLUDE (net), {rnd('net', 0)} AS total_net_capacity_mw,
    {rnd(f"net / (SELECT {total('net')} FROM fuels) * 100", 1)} AS fleet_share_pct FROM fuels"""
STEP["mix"] = f"""SELECT *, {rnd("CAST(sum(CAST(CAST(fleet_share_pct AS VARCHAR) AS DECIMAL(38,12))) OVER (ORDER BY total_net_capacity_mw DESC, fuel_category, fuel_type, state, period ROWS UNBOUNDED PRECEDING) AS DOUBLE)", 1)} AS cumulative_share_pct,
    {ladder('fleet_share_pct', rules.GRID_DEPENDENCY_LABEL, rules.GRID_DEPENDENCY_LABEL_ELSE)} AS grid_dependency_label FROM shares"""
MIX = ["gen", "fleet", "fuels", "shares", "mix"]

STEP["wide"] = f"""SELECT strftime(o_orderdate, '%Y-%m') AS period, {pick('CAST(substr(o_orderpriority, 1, 1) AS INTEGER)', raw.SECTOR_BY_DIGIT)} AS sector,
    o_orderpriority AS sector_name, CAST(count(*) AS DOUBLE) AS customers, {rnd(f"{total('o_totalprice')} / 1000000", 4)} AS revenue,
    {rnd(f"{total('o_totalprice')} / 50000", 3)} AS sales, {rnd(f"{total('o_totalprice')} / count(*) / 20000", 2)} AS price
    FROM orders GROUP BY ALL"""
STEP["long"] = """SELECT period, 'CO' AS state_id, 'Colorado' AS state_name, sector, sector_name, data_type, value, unit FROM (
    SELECT *, 'sales' AS data_type, sales AS value, 'million kWh' AS unit FROM wide UNION ALL
    SELECT *, 'revenue', revenue, 'million dollars' FROM wide UNION ALL
    SELECT *, 'customers', customers, '' FROM wide UNION ALL
    SELECT *, 'price', price, 'cents' FROM wide)"""
STEP["sales"] = f"""SELECT state_id, state_name, sector, sector_name, customers, revenue AS revenue_million_usd, sales AS sales_million_kwh,
    price AS price_cents_per_kwh, CAST(period || '-01' AS DATE) AS sale_month, {rnd('sales * 1000', 0)} AS sales_mwh,
    {rnd('revenue * 1000000', 0)} AS revenue_usd, {rnd('price / 100', 4)} AS price_usd_per_kwh,
    CASE WHEN customers > 0 THEN {rnd('revenue * 1000000 / customers', 2)} END AS revenue_per_customer_usd,
    CAST(substr(period, 1, 4) AS INTEGER) AS year, CAST(substr(period, 6, 2) AS INTEGER) AS month,
    strftime(CAST(period || '-01' AS DATE), '%b') AS month_name, {season("CAST(substr(period, 6, 2) AS INTEGER)", True)} AS season
    FROM (PIVOT long ON data_type IN ('customers', 'revenue', 'sales', 'price') USING max(value)
          GROUP BY period, state_id, state_name, sector, sector_name) WHERE sector <> 'ALL'"""
STEP["trend"] = f"""SELECT * EXCLUDE (state_id, state_name, revenue_million_usd, sales_million_kwh),
    sales_mwh - lag(sales_mwh) OVER w AS sales_mwh_mom_change, sales_mwh - lag(sales_mwh, 12) OVER w AS sales_mwh_yoy_change,
    price_cents_per_kwh - lag(price_cents_per_kwh, 12) OVER w AS price_yoy_change_cents,
    {flag('sales_mwh = max(sales_mwh) OVER (PARTITION BY sector)')} AS is_sector_peak_month,
    {pick('sector', rules.SECTOR_DISPLAY, 'sector_name')} AS sector_display,
    {ladder('price_cents_per_kwh', rules.PRICE_TIER, rules.PRICE_TIER_ELSE)} AS price_tier,
    {flag('sale_month >= (SELECT max(sale_month) FROM sales) - INTERVAL 12 MONTH')} AS is_last_12_months
    FROM sales WINDOW w AS (PARTITION BY sector ORDER BY sale_month)"""
SALES = ["wide", "long", "sales"]

STEP["state_day"] = f"""SELECT weather_date, {rnd(mean('temp_avg_f'), 1)} AS temp_avg_f, {rnd(mean('temp_max_f'), 1)} AS temp_max_f,
    {rnd(mean('temp_min_f'), 1)} AS temp_min_f, {rnd(mean('wind_speed_max_mph'), 1)} AS wind_speed_max_mph,
    {rnd(mean('precipitation_inches'), 2)} AS avg_precipitation_inches,
    {rnd(f"CASE WHEN {mean('temp_avg_f')} >= 65 THEN {mean('temp_avg_f')} - 65 ELSE 0.0::DOUBLE END", 1)} AS cooling_degree_days,
    {rnd(f"CASE WHEN {mean('temp_avg_f')} <= 65 THEN 65 - {mean('temp_avg_f')} ELSE 0.0::DOUBLE END", 1)} AS heating_degree_days
    FROM days GROUP BY weather_date"""
STEP["common"] = """SELECT weather_date, weather_description AS dominant_weather FROM (
    SELECT weather_date, weather_description, row_number() OVER (PARTITION BY weather_date ORDER BY count(*) DESC, weather_description) AS k
    FROM days GROUP BY weather_date, weather_description) WHERE k = 1"""
STEP["state"] = "SELECT * FROM state_day JOIN common USING (weather_date)"
STATE = ["place", "ord", "raw_weather", "days", "state_day", "common", "state"]
STEP["demand_mart"] = f"""SELECT dem.*, s.* EXCLUDE (weather_date),
    CASE WHEN cooling_degree_days > 0 THEN {rnd('peak_demand_mwh / cooling_degree_days', 1)} END AS mwh_per_cooling_degree,
    CASE WHEN heating_degree_days > 0 THEN {rnd('peak_demand_mwh / heating_degree_days', 1)} END AS mwh_per_heating_degree,
    {rnd('peak_demand_mwh / 10642 * 10', 2)} AS demand_pressure_score,
    CASE WHEN temp_avg_f >= 85 AND peak_demand_mwh >= 5500 THEN 'Heat Wave Stress'
         WHEN temp_avg_f <= 20 AND peak_demand_mwh >= 5500 THEN 'Cold Snap Stress'
         WHEN is_critical_peak = 1 THEN 'Grid Critical' WHEN is_high_load = 1 THEN 'High Demand'
         ELSE 'Normal Operations' END AS operational_condition
    FROM dem LEFT JOIN moved s ON demand_date = s.weather_date"""
# Leap days move onto 28 February; the move happens before the daily means, as in the query.
STEP["days_later"] = "SELECT * REPLACE (CAST(weather_date + INTERVAL 288 MONTH AS DATE) AS weather_date) FROM days"

STEP["home"] = "SELECT n_nationkey, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"
STEP["node"] = """SELECT 'R' || r_regionkey AS node_id, 'Transmission Hub' AS node_type, r_name AS city, CAST(345 AS BIGINT) AS voltage_kv, CAST(2500 AS BIGINT) AS capacity_mw FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'Substation', r_name, 230, 1200 FROM home
    UNION ALL SELECT 'S' || s_suppkey, 'Power Plant', r_name, CASE WHEN s_acctbal >= 0 THEN 138 ELSE 69 END, CAST(floor(abs(s_acctbal) / 10) AS BIGINT)
    FROM supplier JOIN home ON s_nationkey = n_nationkey"""
STEP["edge"] = """SELECT 'N' || n_nationkey AS source_node, 'R' || n_regionkey AS target_node, CAST(n_nationkey + 10 AS BIGINT) AS distance_miles,
    CAST(1500 AS BIGINT) AS capacity_mw, 'Transmission' AS line_type FROM nation
    UNION ALL SELECT 'N' || a.n_nationkey, 'N' || b.n_nationkey, 25, 900, 'Transmission' FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 1
    UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, CAST(floor(abs(s_acctbal) / 250) AS BIGINT) + 1, CAST(floor(abs(s_acctbal) / 8) AS BIGINT), 'Distribution' FROM supplier"""
STEP["arc"] = """SELECT source_node AS a, target_node AS b, distance_miles AS w FROM edge
    UNION ALL SELECT target_node, source_node, distance_miles FROM edge"""
STEP["deg"] = """SELECT node_id, count(b) AS degree, count(b) / ((SELECT count(*) FROM node) - 1) AS raw_degree
    FROM node LEFT JOIN (SELECT DISTINCT a, b FROM arc) ON node_id = a GROUP BY node_id"""
STEP["stats"] = f"""SELECT node_id, CAST(sum(n) AS BIGINT) AS connected_lines, CAST(sum(mw) AS BIGINT) AS total_edge_capacity_mw,
    {rnd(mean('miles'), 1)} AS avg_line_distance_miles, max(big) AS max_single_line_capacity FROM (
    SELECT source_node AS node_id, count(*) AS n, sum(capacity_mw) AS mw, {rnd(mean('distance_miles'), 1)} AS miles, max(capacity_mw) AS big FROM edge GROUP BY 1
    UNION ALL SELECT target_node, count(*), sum(capacity_mw), {rnd(mean('distance_miles'), 1)}, max(capacity_mw) FROM edge GROUP BY 1) GROUP BY node_id"""
_node_mart = f"""SELECT n.*, {ladder('betweenness_centrality', rules.CRITICALITY_TIER, rules.CRITICALITY_TIER_ELSE)} AS criticality_tier,
    {ladder('voltage_kv', rules.VOLTAGE_CLASS, rules.VOLTAGE_CLASS_ELSE)} AS voltage_class, {flag('degree_centrality >= 0.3')} AS is_major_hub,
    ifnull(connected_lines, 0) AS connected_lines, ifnull(total_edge_capacity_mw, 0) AS total_edge_capacity_mw,
    ifnull(avg_line_distance_miles, 0) AS avg_line_distance_miles, ifnull(max_single_line_capacity, 0) AS max_single_line_capacity,
    {rnd('degree_centrality * 50 + betweenness_centrality * 50', 1)} AS network_importance_score,
    {rnd('ifnull(total_edge_capacity_mw, 0) / nullif(capacity_mw, 0) * 100', 1)} AS throughput_ratio_pct
    FROM {{}} n LEFT JOIN stats USING (node_id)"""
GRID_MART = _node_mart.format("scored_node")
GRID = ["home", "node", "edge", "arc", "deg", "stats"]

STEP["supply_node"] = "SELECT -1 - s_suppkey AS node FROM supplier UNION ALL SELECT p_partkey FROM part"
STEP["supply_arc"] = """SELECT a, b, min(w) AS w FROM (
    SELECT -1 - l_suppkey AS a, l_partkey AS b, CAST(l_quantity AS BIGINT) AS w FROM lineitem
    UNION ALL SELECT l_partkey, -1 - l_suppkey, CAST(l_quantity AS BIGINT) FROM lineitem) GROUP BY a, b"""
STEP["supply_degree"] = f"""SELECT node, count(b) AS degree, {rnd('count(b) / ((SELECT count(*) FROM supply_node) - 1)', 8)} AS degree_centrality
    FROM supply_node LEFT JOIN supply_arc ON node = a GROUP BY node"""
SUPPLY = ["supply_node", "supply_arc", "supply_degree"]
STEP["ship"] = """SELECT l_orderkey AS a, -1 - (l_suppkey * 1000000 + date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE))) AS b FROM lineitem"""
STEP["ship_arc"] = "SELECT DISTINCT a, b FROM (SELECT a, b FROM ship UNION ALL SELECT b, a FROM ship)"
STEP["ship_node"] = "SELECT o_orderkey AS node FROM orders UNION SELECT b FROM ship"


def sql(steps: list[str], final: str, recursive: str = "") -> str:
    parts = [f"{name} AS ({STEP[name]})" for name in dict.fromkeys(steps)]
    if recursive:
        parts.append(recursive)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + final


def labels_from(nodes: str, arcs: str) -> str:
    """Smallest reachable node per node: every round passes improved labels on."""
    return f"""label(node, low) USING KEY (node) AS (
        SELECT node, node FROM {nodes}
        UNION
        SELECT x.b, min(l.low) FROM label l JOIN {arcs} x ON x.a = l.node
        JOIN recurring.label r ON r.node = x.b WHERE l.low < r.low GROUP BY x.b)"""


def distances_from(start: str, arcs: str) -> str:
    """Shortest distance per (source, node): every round passes improved distances on."""
    return f"""dist(s, v, d) USING KEY (s, v) AS (
        {start}
        UNION
        SELECT f.s, x.b, min(f.d + x.w) FROM dist f JOIN {arcs} x ON x.a = f.v
        LEFT JOIN recurring.dist r ON r.s = f.s AND r.v = x.b
        WHERE r.d IS NULL OR f.d + x.w < r.d GROUP BY f.s, x.b)"""


# Both centralities of the network, after the steps of GRID.
GRID_SCORES = distances_from("SELECT node_id, node_id, CAST(0 AS BIGINT) FROM node", "arc") + f""",
    step AS (SELECT p.s, x.a, x.b FROM arc x JOIN dist p ON p.v = x.a JOIN dist q ON q.s = p.s AND q.v = x.b WHERE p.d + x.w = q.d),
    way AS (SELECT node_id AS s, node_id AS t, [node_id] AS path FROM node
        UNION ALL SELECT way.s, b, list_append(path, b) FROM way JOIN step ON step.s = way.s AND step.a = way.t),
    many AS (SELECT s, t, count(*) AS n FROM way GROUP BY s, t),
    inner_node AS (SELECT unnest(path[2:-2]) AS node_id, 1.0 / n AS part FROM way JOIN many USING (s, t) WHERE len(path) > 2),
    score AS (SELECT node_id, sum(part) / ((SELECT count(*) FROM node) - 1) / ((SELECT count(*) FROM node) - 2) AS bc FROM inner_node GROUP BY 1),
    scored_node AS (SELECT node.*, {even('raw_degree', 4)} AS degree_centrality,
        {even('round(CAST(ifnull(bc, 0) AS DOUBLE), 11)', 4)} AS betweenness_centrality
        FROM node JOIN deg USING (node_id) LEFT JOIN score USING (node_id))"""


def context(fact: str, day: str, columns: str) -> str:
    return f"SELECT f.*, {columns} FROM {fact} f LEFT JOIN days d ON d.weather_date = f.{day} AND d.city_name = f.city_name"


def test_rows(table: str, source: str) -> list[str]:
    rows = []
    for t in MART_TESTS[table]:
        if t.kind == "not_null":
            count = f"SELECT count(*) FROM {source} WHERE {t.column} IS NULL"
        elif t.kind == "accepted_values":
            count = f"SELECT count(*) FROM {source} WHERE NOT {member(t.column, t.values)}"
        else:
            count = f"SELECT count(*) FROM (SELECT {t.column} FROM {source} WHERE {t.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        rows.append(
            f"SELECT '{table}' AS table_name, '{t.column}' AS column_name, '{t.kind}' AS test, "
            f"'{t.severity}' AS severity, ({count}) AS failures, ({count}) = 0 AS passed"
        )
    return rows


def kpi(board: str, source: str, **measures: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{board}' AS board, '{name}' AS measure, CAST({expr} AS DOUBLE) AS value FROM {source}" for name, expr in measures.items()
    )


def counted(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


HIGH_ONLY = "ops_risk_label = 'High'"
SHORT = "d.temp_max_f, d.wind_speed_max_mph, d.weather_description"
CLASSED = f"""SELECT *, {ladder('capacity_mw', rules.LINE_CAPACITY_TIER, rules.LINE_CAPACITY_TIER_ELSE)} AS capacity_tier,
    {ladder('distance_miles', rules.LINE_DISTANCE_BUCKET, rules.LINE_DISTANCE_BUCKET_ELSE)} AS distance_bucket FROM edge"""
FLAG_OF = {"wind": "is_high_wind", "freeze": "is_freeze_risk", "precip": "is_heavy_precip", "heat": "is_heat_alert"}


def regime(order) -> str:
    return "CASE " + " ".join(f"WHEN {FLAG_OF[n]} = 1 THEN '{n}'" for n in order) + " ELSE 'none' END"


STEP["moved"] = STEP["state"].replace("state_day", "state_day_later").replace("common", "common_later")
STEP["state_day_later"] = STEP["state_day"].replace("FROM days", "FROM days_later")
STEP["common_later"] = STEP["common"].replace("FROM days", "FROM days_later")
DEMAND_MART = [*DEMAND, *WEATHER[:4], "days_later", "state_day_later", "common_later", "moved", "demand_mart"]

_gap_dims = (
    f"CROSS JOIN (VALUES {', '.join(f'({text(a)})' for a in rules.ASSET_MULTIPLIER)}) a(asset_type) "
    f"CROSS JOIN (VALUES {', '.join(f'({text(c)})' for c in rules.CATEGORY_MULTIPLIER)}) c(cost_category)"
)

ORACLE: dict[str, str] = {
    "q01_ops_summary_ranked": sql([*DAILY, "city", "ranked"], "SELECT * FROM ranked"),
    "q02_ops_summary_daily": sql(DAILY, "SELECT * FROM daily"),
    "q03_daily_demand": sql(DEMAND, "SELECT * FROM dem"),
    "q04_spend_bands": sql([*SPEND, "spend_mart"], "SELECT * FROM spend_mart"),
    "q05_generator_bands": sql(["gen", "fleet"], "SELECT * FROM fleet"),
    "q06_weather_days": sql(WEATHER, "SELECT * FROM wx"),
    "q07_outages_operations": sql([*WEATHER[:4], *OUT], context("out", "outage_date", SHORT + ", d.temp_min_f, d.temp_avg_f, d.precipitation_inches")),
    "q08_safety_operations": sql([*WEATHER[:4], *SAF], context("saf", "obs_date", SHORT)),
    "q09_workforce_operations": sql([*WEATHER[:4], *WF], context("wf", "work_date", SHORT)),
    "q10_weather_regime": sql(
        [*WEATHER, *OUT, "out_day"],
        f"""SELECT weather_date, wx.city_name, ops_risk_score, {regime(rules.OUTAGE_REGIME_ORDER)} AS outage_regime,
        {regime(rules.SAFETY_REGIME_ORDER)} AS safety_regime, CAST({pick('ops_risk_score', rules.EXPECTED_OUTAGES)} AS DOUBLE) AS expected_outages,
        {pick('ops_risk_score', rules.EXPECTED_OBSERVATIONS)} AS expected_observations, ifnull(n_out, 0) AS total_outages,
        {rnd(f"ifnull(n_out, 0) / CAST({pick('ops_risk_score', rules.EXPECTED_OUTAGES)} AS DOUBLE)", 3)} AS observed_to_expected
        FROM wx LEFT JOIN out_day ON day = weather_date AND out_day.city_name = wx.city_name""",
    ),
    "q11_demand_weather": sql(DEMAND_MART, "SELECT * FROM demand_mart"),
    "q12_calendar_parts": f"""SELECT o_orderkey, day, {year('day')} AS year, {month('day')} AS month, {week('day')} AS week_num,
        CAST(dayofweek(day) AS INTEGER) AS day_of_week, dayname(day) AS day_name, {flag('dayofweek(day) IN (0, 6)')} AS is_weekend,
        strftime(day, '%b') AS month_short, monthname(day) AS month_long, strftime(day, '%Y-%m') AS period,
        CAST(date_trunc('month', day) AS DATE) AS period_month, {season('month(day)')} AS season,
        {season('nullif(month(day), 1)', True)} AS season_else_fall, {season('nullif(month(day), 1)')} AS season_or_null
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "q13_grid_operations": sql(GRID, GRID_MART, GRID_SCORES),
    "q14_generator_mix": sql(MIX, "SELECT * FROM mix"),
    "q15_sales_by_sector": sql([*SALES, "trend"], "SELECT * FROM trend"),
    "q16_edge_classes": sql(["edge"], CLASSED),
    "q17_latest_fleet": sql(
        ["gen"],
        f"""SELECT fuel_type, total_mw, {rnd(f"total_mw / (sum(total_mw) OVER ()) * 100", 1)} AS share_pct FROM (
        SELECT fuel_type, {total('net_summer_capacity_mw')} AS total_mw FROM gen WHERE period = (SELECT max(period) FROM gen) GROUP BY 1)
        QUALIFY total_mw > 0""",
    ),
    "q18_seasonal": sql(
        DAILY,
        f"""SELECT season, count(*) AS total_days, {rnd(mean('total_outages'), 2)} AS avg_outages,
        {rnd(mean('total_customer_minutes_lost'), 0)} AS avg_cml, {rnd(mean('operational_stress_score'), 3)} AS avg_stress,
        {total('total_labor_cost')} AS total_labor_cost FROM daily GROUP BY season""",
    ),
    "q19_grid_by_city": sql(
        [*DAILY, "city", "ranked", *GRID],
        f"""SELECT r.city_name, stress_rank, risk_label, avg_stress_score, avg_daily_outages, facility_count, total_capacity_mw,
        avg_importance_score, avg_betweenness FROM ranked r LEFT JOIN (
        SELECT city, count(*) AS facility_count, CAST(sum(capacity_mw) AS BIGINT) AS total_capacity_mw,
        {rnd(mean('network_importance_score'), 1)} AS avg_importance_score, {rnd(mean('betweenness_centrality'), 3)} AS avg_betweenness
        FROM ({GRID_MART}) GROUP BY city) g ON g.city = replace(r.city_name, '_', ' ')""",
        GRID_SCORES,
    ),
    "q20_high_stress_topk": sql(
        DAILY,
        """SELECT summary_date, city_name, operational_stress_score, total_outages, total_customer_minutes_lost, ops_risk_label, season
        FROM daily WHERE operational_stress_score >= 2 ORDER BY operational_stress_score DESC, summary_date, city_name LIMIT 10""",
    ),
    "q21_monthly_risk": sql(
        WEATHER,
        f"""SELECT city_name, month_num, year, season, CAST(sum(ops_risk_score) AS BIGINT) AS total_risk, {mean('ops_risk_score')} AS avg_risk,
        CAST(sum(is_high_wind) AS BIGINT) AS wind_days, CAST(sum(is_freeze_risk) AS BIGINT) AS freeze_days,
        CAST(sum(is_heat_alert) AS BIGINT) AS heat_days, count(*) AS total_days FROM wx GROUP BY ALL""",
    ),
    "q22_value_counts": sql(["place", "raw_out"], "SELECT city_name AS city, outage_cause AS cause, count(*) AS count FROM raw_out GROUP BY 1, 2"),
    "q23_totals": sql(
        SPEND,
        " UNION ALL ".join(
            f"SELECT '{name}' AS dimension, {member_} AS member, {total('amount_usd')} AS total_amount_usd FROM sp GROUP BY 1, 2"
            for name, member_ in (("all", "'all'"), ("city", "city"), ("asset_type", "asset_type"))
        ),
    ),
    "q24_column_profile": f"SELECT min(value) AS min_value, max(value) AS max_value, {mean('value')} AS avg_value, count(value) AS non_null FROM events",
    "q25_crosstab": sql(
        SPEND, "SELECT city, " + ", ".join(f"CAST(sum({exact('amount_usd')}) FILTER (spend_month = {m}) AS DOUBLE) AS \"{m}\"" for m in range(1, 13)) + " FROM sp GROUP BY city"
    ),
    "q26_dashboard_measures": sql(
        [*DAILY, "sp", "spend_mart", *SALES],
        " UNION ALL ".join([
            kpi("stress", "daily", avg_stress_score=mean("operational_stress_score"), peak_stress_score="max(operational_stress_score)",
                high_stress_days=counted("operational_stress_score >= 7"),
                elevated_stress_days=counted("operational_stress_score >= 4 AND operational_stress_score < 7"),
                high_risk_day_share=f"ifnull({counted(HIGH_ONLY)} / nullif(count(*), 0), 0)"),
            kpi("outages", "daily", total_outages="sum(total_outages)", total_cml=total("total_customer_minutes_lost"),
                total_customers_affected="sum(total_customers_affected)", avg_outage_duration=mean("avg_outage_duration_hrs"),
                weather_driven_outages="sum(weather_driven_outages)", unplanned_outages="sum(unplanned_outages)"),
            kpi("spend", "spend_mart", total_om_spend=total("amount_usd"), avg_cost_per_risk_point=mean("cost_per_risk_point"),
                high_spend_count=counted("is_high_spend = 1"), avg_om_risk_score=mean("avg_risk_score")),
            kpi("workforce", "wf", total_labor_cost=total("labor_cost"), total_overtime_cost=total("overtime_premium_cost"),
                total_hours_worked=total("hours_worked")),
            kpi("safety", "saf", avg_safety_risk=mean("safety_risk_index"), total_incidents=counted("is_incident = 1"),
                overdue_closures=counted("is_overdue = 1")),
            kpi("market", "sales", total_revenue=total("revenue_usd"), total_sales_mwh=total("sales_mwh"),
                avg_price_per_kwh=mean("price_usd_per_kwh"), total_customers=total("customers")),
        ]),
    ),
    "q27_charts": sql(["place", "ord", *WF], f"""SELECT CASE grouping(year, month_num, crew_type, city_name, weather_risk_score)
        WHEN 3 THEN 'month' WHEN 29 THEN 'city' ELSE 'weather' END AS chart, year, month_num, crew_type, city_name, weather_risk_score,
        {total('labor_cost')} AS total_labor_cost, count(*) AS shifts
        FROM wf GROUP BY GROUPING SETS ((year, month_num, crew_type), (city_name), (weather_risk_score))"""),
    "q28_quality_report": sql(
        [*WEATHER, *DEMAND_MART, *MIX, *SALES, "trend"],
        " UNION ALL ".join([
            *test_rows("mart_weather_operations", "wx"), *test_rows("mart_eia_weather", "demand_mart"),
            *test_rows("mart_generator_mix", "mix"), *test_rows("mart_eia_sales_by_sector", "trend"),
        ]),
    ),
    "q29_dropna_coerce": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
        TRY_CAST(nullif(regexp_extract(props, '"k": (\\d)\\d}', 1), '') AS DOUBLE) AS tens, CAST(NULL AS DOUBLE) AS not_a_number
        FROM events WHERE regexp_matches(props, '"k": \\d\\d}')""",
    "q30_degree_centrality": sql(SUPPLY, "SELECT * FROM supply_degree"),
    "q31_components": sql(
        ["ship", "ship_arc", "ship_node"], "SELECT node, low AS component FROM label", labels_from("ship_node", "ship_arc")
    ),
    "q32_node_removal": sql(
        ["home", "node", "edge", "arc", "deg"], "SELECT node, low AS component FROM label",
        """gone AS (SELECT node_id AS g FROM deg ORDER BY degree DESC, node_id LIMIT 1),
        rest AS (SELECT node_id AS node FROM node, gone WHERE node_id <> g),
        rest_arc AS (SELECT a, b FROM arc, gone WHERE a <> g AND b <> g),
        """ + labels_from("rest", "rest_arc"),
    ),
    "q33_shortest_distances": sql(
        ["supply_arc"], "SELECT v AS node, d AS distance FROM dist",
        distances_from("SELECT CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT)", "supply_arc"),
    ),
    "q34_shortest_path": sql(
        ["edge", "arc"], """SELECT CAST(len(path) - h AS INTEGER) AS step, path[h] AS node, d AS distance FROM
        (SELECT path, unnest(range(1, len(path) + 1)) AS h FROM way WHERE here = 'S0') JOIN dist ON v = path[h]""",
        distances_from("SELECT 'S0', 'S0', CAST(0 AS BIGINT)", "arc") + """,
        before AS (SELECT b, min(a) AS a FROM arc JOIN dist p ON p.v = a JOIN dist q ON q.v = b WHERE p.d + w = q.d GROUP BY b),
        way AS (SELECT 'S7' AS here, ['S7'] AS path UNION ALL SELECT a, list_append(path, a) FROM way JOIN before ON b = here)""",
    ),
    "q35_betweenness": sql(
        GRID,
        "SELECT node_id, city, degree_centrality, betweenness_centrality, criticality_tier, is_major_hub, connected_lines, network_importance_score FROM ("
        + GRID_MART + ")",
        GRID_SCORES,
    ),
    "q36_cause_mix": sql(
        [*WEATHER, *OUT],
        f"""SELECT regime, outage_cause, n AS count, CAST(g AS BIGINT) AS group_count, {rnd('n / g', 4)} AS share FROM (
        SELECT regime, outage_cause, count(*) AS n, sum(count(*)) OVER (PARTITION BY regime) AS g FROM (
        SELECT ifnull(r, 'no weather') AS regime, outage_cause FROM out LEFT JOIN
        (SELECT weather_date, city_name AS c, {regime(rules.OUTAGE_REGIME_ORDER)} AS r FROM wx) ON weather_date = outage_date AND c = city_name) GROUP BY 1, 2)""",
    ),
    "q37_coverage_gaps": sql(
        SPEND,
        f"""SELECT m.*, asset_type, cost_category FROM (SELECT DISTINCT city, spend_year, spend_month FROM sp) m {_gap_dims}
        EXCEPT SELECT city, spend_year, spend_month, asset_type, cost_category FROM sp""",
    ),
    "q38_staffing_gap": sql(
        [*WEATHER, *WF, "wf_day"],
        f"""SELECT weather_date, wx.city_name, CAST({pick('wx.city_name', REGION_CREWS)} + {pick('ops_risk_score', rules.EXTRA_CREWS)} AS INTEGER) AS required_crews,
        ifnull(crews, 0) AS deployed_crews,
        ifnull(crews, 0) - CAST({pick('wx.city_name', REGION_CREWS)} + {pick('ops_risk_score', rules.EXTRA_CREWS)} AS INTEGER) AS crew_gap
        FROM wx LEFT JOIN wf_day ON day = weather_date AND wf_day.city_name = wx.city_name""",
    ),
    "q39_date_window": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus, o_orderpriority FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-08-01' - 90 AND DATE '2001-08-01' - 5
        AND o_orderstatus IN ('F', 'O') AND o_orderpriority <> '3-MEDIUM'""",
    "q40_json_records": "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events",
    "q41_concat_sources": """SELECT 'supplier' AS kind, s_suppkey AS key, s_acctbal AS amount FROM supplier
        UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part""",
    "q42_label_join": """SELECT c_custkey, CASE WHEN n_regionkey <> 4 THEN n_name ELSE CAST(c_nationkey AS VARCHAR) END AS nation_label,
        CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment_text FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "q43_sales_melt": sql(["wide", "long"], "SELECT * FROM long"),
    "q44_sales_pivot": sql(SALES, "SELECT * FROM sales"),
    "q45_state_weather": sql(STATE, "SELECT * FROM state"),
    "q46_high_stress_days": sql(
        DAILY,
        """SELECT summary_date, city_name, operational_stress_score, total_outages, total_customer_minutes_lost, ops_risk_label, season
        FROM daily WHERE operational_stress_score >= 2""",
    ),
    "q47_newest_periods": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period FROM orders ORDER BY 1 DESC LIMIT 10",
    "q48_peak_months": sql(["wide"], f"SELECT sector_name AS \"sectorName\", period, sales, {flag('sales = max(sales) OVER (PARTITION BY sector_name)')} AS is_peak FROM wide"),
    "q49_top_hubs": sql(SUPPLY, "SELECT * FROM supply_degree ORDER BY degree_centrality DESC, node LIMIT 5"),
    "q50_network_counts": sql(
        ["supply_node", "supply_arc"], "SELECT (SELECT count(*) FROM supply_arc WHERE a < b) AS edges, (SELECT count(*) FROM supply_node) AS nodes"
    ),
    "q51_spend_normalised": sql(
        SPEND,
        f"""SELECT spend_id, 1 + avg_risk_score * 0.25::DOUBLE AS risk_multiplier,
        {rnd(f"amount_usd / (CAST({pick('asset_type', rules.ASSET_MULTIPLIER)} AS DOUBLE) * CAST({pick('cost_category', rules.CATEGORY_MULTIPLIER)} AS DOUBLE) * (1 + avg_risk_score * 0.25::DOUBLE))", 2)} AS base_amount FROM sp""",
    ),
    "q52_weather_staging": sql(WEATHER[:4], "SELECT * FROM days"),
    "q53_city_counts": sql(
        DAILY,
        f"""SELECT city_name, {counted('operational_stress_score >= 7')} AS high_stress_days, {counted("ops_risk_label = 'Monitor'")} AS monitor_days,
        {mean('labor_cost_per_outage')} AS avg_labor_cost_per_outage FROM daily GROUP BY city_name""",
    ),
    "q54_landed_demand": sql(DEMAND, "SELECT * FROM dem"),
    "q55_page_report": """SELECT 'raw_eia_demand' AS table_name, count(*) AS fetched, count(*) AS announced, true AS complete,
        CAST(1 AS BIGINT) AS bad_pages FROM events""",
    "q56_weather_csv": sql(WEATHER[:4], "SELECT * FROM days"),
    "q57_weather_pages": sql(WEATHER[:4], "SELECT * FROM days"),
    "q58_landed_generators": sql(["gen", "fleet"], "SELECT * FROM fleet"),
    "q59_published_export": sql(
        [*DAILY, "city", "ranked"],
        """SELECT city_name, CAST(stress_rank AS INTEGER) AS stress_rank, risk_label, avg_stress_score, avg_daily_outages,
        CAST(total_outages AS DOUBLE) AS total_outages, CAST(total_customer_minutes_lost AS DOUBLE) AS total_customer_min_lost,
        avg_crews_per_day, total_labor_cost, avg_temperature_f, avg_heating_degree_days, avg_cooling_degree_days,
        CASE stress_rank WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE 'later' END AS place FROM ranked""",
    ),
    "q60_is_connected": sql(
        ["ship", "ship_arc", "ship_node", "home", "node", "edge", "arc"],
        """SELECT 'shipments' AS network, count(DISTINCT low) AS islands, count(DISTINCT low) = 1 AS connected FROM label
        UNION ALL SELECT 'grid', count(DISTINCT piece), count(DISTINCT piece) = 1 FROM
        (SELECT coalesce(min(v), any_value(node_id)) AS piece FROM node LEFT JOIN dist ON v = node_id GROUP BY v IS NULL, CASE WHEN v IS NULL THEN node_id END)""",
        labels_from("ship_node", "ship_arc") + ", " + distances_from("SELECT 'S0', 'S0', CAST(0 AS BIGINT)", "arc"),
    ),
    "q61_state_trends": f"""WITH months AS (SELECT o_orderstatus, o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
        count(*) AS orders, {total('o_totalprice')} AS total FROM orders GROUP BY 1, 2, 3)
        SELECT * REPLACE ({rnd('total', 2)} AS total), orders - lag(orders) OVER w AS orders_mom, orders - lag(orders, 12) OVER w AS orders_yoy,
        {rnd('total - lag(total, 12) OVER w', 2)} AS total_yoy
        FROM months WINDOW w AS (PARTITION BY o_orderstatus, o_orderpriority ORDER BY month)""",
}
