"""Marts, built from staging models.

Each ``*_kpis`` function adds the measures of one domain row by row. The
``*_operations`` marts join the day's weather to those rows. The daily summary
aggregates the KPI rows directly: it needs no weather column of theirs, so the
detail rows are never shuffled for a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import calendar, energy, field, grid, weather
from ..functions.core import as_decimal, exact_avg, exact_sum, known, strict_greatest
from ..operators import ordered
from ..operators.joins import spine_join, with_context
from ..operators.rollups import most_frequent
from ..session import materialize


def weather_operations(days: DataFrame, precip_unit_scale: float = 1.0) -> DataFrame:
    flags = days.withColumns(
        {
            "heating_degree_days": calendar.heating_degree_days("temp_avg_f"),
            "cooling_degree_days": calendar.cooling_degree_days("temp_avg_f"),
            "is_freeze_risk": weather.freeze_risk("temp_min_f"),
            "is_heat_alert": weather.heat_alert("temp_max_f"),
            "is_high_wind": weather.high_wind("wind_speed_max_mph"),
            "is_heavy_precip": weather.heavy_precip("precipitation_inches", unit_scale=precip_unit_scale),
            "season": calendar.season(F.month("weather_date")),
            "year": F.year("weather_date"),
            "month_num": F.month("weather_date"),
            "week_num": calendar.iso_week("weather_date"),
        }
    ).drop("weather_code")
    return flags.withColumn(
        "ops_risk_score", weather.risk_score("is_freeze_risk", "is_heat_alert", "is_high_wind", "is_heavy_precip")
    ).withColumn("ops_risk_label", weather.risk_label("ops_risk_score"))


def outage_kpis(outages: DataFrame) -> DataFrame:
    return outages.withColumns(
        {
            "customer_minutes_lost": field.customer_minutes_lost("customers_affected", "duration_hours"),
            "outage_severity_score": field.outage_severity("customers_affected", "duration_hours"),
            "is_weather_driven": field.weather_driven("outage_cause"),
            "year": F.year("outage_date"),
            "month_num": F.month("outage_date"),
            "day_of_week": calendar.day_of_week("outage_date"),
        }
    )


def safety_kpis(safety: DataFrame) -> DataFrame:
    return safety.withColumns(
        {
            "safety_risk_index": field.safety_risk_index("severity_score", "weather_risk_score"),
            "is_overdue": field.overdue("severity", "days_to_close"),
            "is_incident": field.incident("observation_type"),
            "year": F.year("obs_date"),
            "month_num": F.month("obs_date"),
        }
    )


def workforce_kpis(workforce: DataFrame) -> DataFrame:
    return workforce.withColumns(
        {
            "overtime_premium_cost": field.overtime_premium("is_overtime", "labor_cost", "hours_worked", "hourly_rate"),
            "shift_length_bucket": field.shift_length_bucket("hours_worked"),
            "year": F.year("work_date"),
            "month_num": F.month("work_date"),
            "week_num": calendar.iso_week("work_date"),
        }
    )


_WEATHER_CONTEXT = ["temp_max_f", "wind_speed_max_mph", "weather_description"]


def outages_operations(outages: DataFrame, days: DataFrame) -> DataFrame:
    context = [*_WEATHER_CONTEXT, "temp_min_f", "temp_avg_f", "precipitation_inches"]
    return with_context(outage_kpis(outages), days, {"outage_date": "weather_date", "city_name": "city_name"}, context)


def safety_operations(safety: DataFrame, days: DataFrame) -> DataFrame:
    return with_context(safety_kpis(safety), days, {"obs_date": "weather_date", "city_name": "city_name"}, _WEATHER_CONTEXT)


def workforce_operations(workforce: DataFrame, days: DataFrame) -> DataFrame:
    return with_context(workforce_kpis(workforce), days, {"work_date": "weather_date", "city_name": "city_name"}, _WEATHER_CONTEXT)


def om_spend_mart(spend: DataFrame) -> DataFrame:
    return spend.withColumns(
        {
            "cost_per_risk_point": field.cost_per_risk_point("amount_usd", "avg_risk_score"),
            "season": calendar.season("spend_month"),
            "is_high_spend": field.high_spend("amount_usd"),
        }
    )


def daily_outages(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy(F.col("outage_date").alias("summary_date"), "city_name").agg(
        F.count("outage_id").alias("total_outages"),
        F.sum("customers_affected").alias("total_customers_affected"),
        exact_sum("customer_minutes_lost").alias("total_customer_minutes_lost"),
        F.round(exact_avg("duration_hours"), 2).alias("avg_outage_duration_hrs"),
        F.max("outage_severity_score").alias("max_outage_severity"),
        F.sum("is_weather_driven").alias("weather_driven_outages"),
        F.count_if(F.col("outage_type") == "Unplanned").alias("unplanned_outages"),
    )


def daily_workforce(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy(F.col("work_date").alias("summary_date"), "city_name").agg(
        F.count("record_id").alias("total_crews_deployed"),
        exact_sum("hours_worked").alias("total_hours_worked"),
        F.round(exact_sum("labor_cost"), 2).alias("total_labor_cost"),
        F.round(exact_sum("overtime_premium_cost"), 2).alias("total_overtime_cost"),
        F.sum("is_emergency_deployment").alias("emergency_deployments"),
        F.sum("is_overtime").alias("overtime_shifts"),
    )


def daily_safety(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy(F.col("obs_date").alias("summary_date"), "city_name").agg(
        F.count("obs_id").alias("total_observations"),
        F.sum("is_incident").alias("total_incidents"),
        F.round(exact_avg("severity_score"), 2).alias("avg_severity_score"),
        F.max("safety_risk_index").alias("max_safety_risk_index"),
        F.sum("is_overdue").alias("overdue_closures"),
        F.count_if(F.col("observation_category") == "Positive").alias("positive_observations"),
    )


OUTAGE_DAILY = [
    "total_outages", "total_customers_affected", "total_customer_minutes_lost", "avg_outage_duration_hrs",
    "max_outage_severity", "weather_driven_outages", "unplanned_outages",
]
WORKFORCE_DAILY = [
    "total_crews_deployed", "total_hours_worked", "total_labor_cost", "total_overtime_cost",
    "emergency_deployments", "overtime_shifts",
]
SAFETY_DAILY = [
    "total_observations", "total_incidents", "avg_severity_score", "max_safety_risk_index",
    "overdue_closures", "positive_observations",
]


def operations_summary(weather_mart: DataFrame, outages: DataFrame, workforce: DataFrame, safety: DataFrame) -> DataFrame:
    """One row per day and city of the weather mart.

    The facts may be ``*_kpis`` rows or the ``*_operations`` marts. They are
    aggregated to the grain before the joins, so no join multiplies rows.
    """
    spine = weather_mart.select(
        F.col("weather_date").alias("summary_date"), "city_name", "season", "year", "month_num", "week_num",
        "temp_max_f", "temp_min_f", "temp_avg_f", "precipitation_inches", "wind_speed_max_mph",
        "weather_description", "heating_degree_days", "cooling_degree_days", "ops_risk_score", "ops_risk_label",
    )
    facts = [daily_outages(outages), daily_workforce(workforce), daily_safety(safety)]
    joined = spine_join(spine, facts, ["summary_date", "city_name"])
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in [*OUTAGE_DAILY, *WORKFORCE_DAILY, *SAFETY_DAILY]]
    return joined.select(
        *spine.columns,
        *filled,
        field.labor_cost_per_outage("total_labor_cost", "total_outages").alias("labor_cost_per_outage"),
        field.incident_rate_per_crew("total_incidents", "total_crews_deployed").alias("incident_rate_per_crew"),
        field.operational_stress("ops_risk_score", "max_outage_severity", "avg_severity_score").alias("operational_stress_score"),
    )


def state_weather(days: DataFrame, base: float = rules.DEGREE_DAY_BASE_F) -> DataFrame:
    """Cities to one row per day: means, degree days of the unrounded mean, most common description."""
    digits = {"temp_avg_f": 1, "temp_max_f": 1, "temp_min_f": 1, "wind_speed_max_mph": 1, "precipitation_inches": 2}
    parts, mean = {}, {}
    for name in digits:
        amount = known(name)
        exact = as_decimal(amount)
        # As in ``exact_avg``: decimals where they hold every value, doubles otherwise.
        parts |= {
            f"{name}__sum": (F.try_sum(exact), F.try_sum(f"{name}__sum")), f"{name}__held": (F.count(exact), F.sum(f"{name}__held")),
            f"{name}__plain": (F.sum(amount), F.sum(f"{name}__plain")), f"{name}__n": (F.count(amount), F.sum(f"{name}__n")),
        }
        held = F.when(F.col(f"{name}__held") == F.col(f"{name}__n"), F.col(f"{name}__sum").cast("double"))
        mean[name] = F.try_divide(F.coalesce(held, f"{name}__plain"), F.col(f"{name}__n").cast("double"))
    daily = most_frequent(days, ["weather_date"], "weather_description", "dominant_weather", parts)
    zero, base_lit = F.lit(0.0), F.lit(float(base))
    return daily.select(
        "weather_date",
        *[
            F.round(mean[name], n).alias("avg_precipitation_inches" if name == "precipitation_inches" else name)
            for name, n in digits.items()
        ],
        F.round(strict_greatest(mean["temp_avg_f"] - base_lit, zero), 1).alias("cooling_degree_days"),
        F.round(strict_greatest(base_lit - mean["temp_avg_f"], zero), 1).alias("heating_degree_days"),
        "dominant_weather",
    )


def demand_weather(demand: DataFrame, days: DataFrame) -> DataFrame:
    context = state_weather(days)
    joined = with_context(
        demand, context, {"demand_date": "weather_date"}, [c for c in context.columns if c != "weather_date"]
    )
    return joined.withColumns(
        {
            "mwh_per_cooling_degree": energy.mwh_per_degree("peak_demand_mwh", "cooling_degree_days"),
            "mwh_per_heating_degree": energy.mwh_per_degree("peak_demand_mwh", "heating_degree_days"),
            "demand_pressure_score": energy.demand_pressure("peak_demand_mwh"),
            "operational_condition": energy.operational_condition(
                "temp_avg_f", "peak_demand_mwh", "is_critical_peak", "is_high_load"
            ),
        }
    )


def generator_mix(generators: DataFrame) -> DataFrame:
    """Fleet by fuel. Aggregated once and written, since share and running share read it again."""
    net = "net_summer_capacity_mw"
    fuels = materialize(
        generators.groupBy("fuel_category", "fuel_type", "state", "period").agg(
            F.count("*").alias("generator_count"),
            exact_sum(net).alias("__net"),
            F.round(exact_sum("nameplate_capacity_mw"), 0).alias("total_nameplate_capacity_mw"),
            F.round(exact_avg("capacity_efficiency_pct"), 1).alias("avg_efficiency_pct"),
            F.round(exact_avg(net), 1).alias("avg_generator_size_mw"),
            F.max(net).alias("largest_generator_mw"),
            F.max("is_clean_energy").alias("is_clean_energy"),
            F.max("is_dispatchable").alias("is_dispatchable"),
        )
    )
    shared = ordered.share_of_total(fuels, "__net", "fleet_share_pct").withColumn(
        "total_net_capacity_mw", F.round("__net", 0)
    )
    # Equal rounded totals are ordered by their keys, so the running share is repeatable.
    running = ordered.running_total(
        shared, "fleet_share_pct", "__running",
        F.col("total_net_capacity_mw").desc_nulls_first(), "fuel_category", "fuel_type", "state", "period",
    )
    return running.withColumns(
        {
            "cumulative_share_pct": F.round("__running", 1),
            "grid_dependency_label": energy.grid_dependency("fleet_share_pct"),
        }
    ).drop("__net", "__running")


def sales_by_sector(sales: DataFrame, group: Sequence[str] = ("state_id", "sector")) -> DataFrame:
    """Monthly sales with trends within each ``group``, in which a month occurs once.

    The pivoted months are written once, since several steps read them.
    """
    sales = materialize(sales)
    latest = sales.agg(F.max("sale_month")).scalar()
    group, month = list(group), "sale_month"
    changes = {
        "sales_mwh_mom_change": ("sales_mwh", 1),
        "sales_mwh_yoy_change": ("sales_mwh", 12),
        "price_yoy_change_cents": ("price_cents_per_kwh", 12),
    }
    trend = ordered.lag_changes(sales, group, [month], changes)
    trend = ordered.group_peak_flag(trend, "sales_mwh", "is_sector_peak_month", group)
    return trend.withColumns(
        {
            "sector_display": energy.sector_display("sector", "sector_name"),
            "price_tier": energy.price_tier("price_cents_per_kwh"),
            "is_last_12_months": calendar.within_last_months(month, latest),
        }
    ).drop("state_id", "state_name", "revenue_million_usd", "sales_million_kwh")


def node_line_stats(edges: DataFrame) -> DataFrame:
    """Line statistics per node. The mean distance is the plain mean of the two end-wise means."""
    per_end = [
        edges.groupBy(F.col(end).alias("node_id")).agg(
            F.count("*").alias("connected_lines"),
            F.sum("capacity_mw").alias("total_edge_capacity_mw"),
            F.round(exact_avg("distance_miles"), 1).alias("avg_line_distance_miles"),
            F.max("capacity_mw").alias("max_single_line_capacity"),
        )
        for end in ("source_node", "target_node")
    ]
    return per_end[0].unionByName(per_end[1]).groupBy("node_id").agg(
        F.sum("connected_lines").alias("connected_lines"),
        F.sum("total_edge_capacity_mw").alias("total_edge_capacity_mw"),
        F.round(exact_avg("avg_line_distance_miles"), 1).alias("avg_line_distance_miles"),
        F.max("max_single_line_capacity").alias("max_single_line_capacity"),
    )


def grid_operations(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with their line statistics, most central first when shown with ``by_centrality``."""
    stats = node_line_stats(edges)
    measures = [c for c in stats.columns if c != "node_id"]
    joined = with_context(nodes, stats, {"node_id": "node_id"}, measures)
    return joined.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in measures},
            "network_importance_score": grid.importance_score("degree_centrality", "betweenness_centrality"),
            "throughput_ratio_pct": grid.throughput_ratio("total_edge_capacity_mw", "capacity_mw"),
        }
    )


def by_centrality(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("betweenness_centrality").desc_nulls_last(), "node_id")
