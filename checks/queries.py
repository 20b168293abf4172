"""Registered queries: each runs library code over the whole given tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart import rules, schemas, session
from opsmart.functions import calendar, field, weather as weather_functions
from opsmart.functions.core import count_if, exact_avg, exact_sum, text_or_empty, to_number
from opsmart.operators import filters, graph, joins, ordered, reshape, rollups
from opsmart.operators.betweenness import scored_nodes
from opsmart.plans import contracts, ingest, marts, measures, staging, summaries
from opsmart.session import materialize
from opsmart.sources import readers, writers

from . import raw_frames as raw

REGION_CREWS = {"AFRICA": 8, "AMERICA": 5, "ASIA": 3, "EUROPE": 3, "MIDDLE_EAST": 2}
AS_OF = dt.date(2001, 8, 1)


def _days(s, d):
    return staging.weather_days(raw.weather(s, d))


def _weather_mart(s, d):
    return marts.weather_operations(_days(s, d))


def _daily(s, d, placed=None):
    placed = placed or raw.written_orders(s, d)
    return marts.operations_summary(
        marts.weather_operations(staging.weather_days(raw.weather(s, d, placed))),
        marts.outage_kpis(staging.outages(raw.outages(s, d))),
        marts.workforce_kpis(staging.workforce(raw.workforce(s, d, placed))),
        marts.safety_kpis(staging.safety(raw.safety(s, d, placed))),
    )


def _raw_demand(s, d):
    hours = raw.meter_hours(s, d).select("ts", to_number("value").alias("demand_mwh"))
    return staging.daily_demand(hours)


def _demand_days(s, d):
    """Daily weather moved to the days of the demand, since events and orders do not overlap in time."""
    days = _days(s, d)
    return days.withColumn("weather_date", F.add_months("weather_date", 12 * 24))


def ops_summary_ranked(s: SparkSession, d: str) -> DataFrame:
    return summaries.ranked_cities(_daily(s, d))


def ops_summary_daily(s, d):
    return _daily(s, d)


def daily_demand(s, d):
    return staging.demand(_raw_demand(s, d))


def spend_bands(s, d):
    return marts.om_spend_mart(staging.om_spend(raw.spend(s, d)))


def generator_bands(s, d):
    return staging.generators(raw.generators(s, d))


def weather_days(s, d):
    return _weather_mart(s, d)


def weather_staging(s, d):
    return _days(s, d)


def outages_operations(s, d):
    return marts.outages_operations(staging.outages(raw.outages(s, d)), _days(s, d))


def safety_operations(s, d):
    return marts.safety_operations(staging.safety(raw.safety(s, d)), _days(s, d))


def workforce_operations(s, d):
    return marts.workforce_operations(staging.workforce(raw.workforce(s, d)), _days(s, d))


def weather_regime(s, d):
    """Regime by both precedences, and outages seen against outages expected for the day's risk."""
    seen = marts.daily_outages(marts.outage_kpis(staging.outages(raw.outages(s, d))))
    joined = joins.with_context(
        _weather_mart(s, d), seen, {"weather_date": "summary_date", "city_name": "city_name"}, ["total_outages"]
    )
    expected = field.expected_outages("ops_risk_score")
    total = F.coalesce("total_outages", F.lit(0))
    return joined.select(
        "weather_date", "city_name", "ops_risk_score",
        weather_functions.regime(rules.OUTAGE_REGIME_ORDER).alias("outage_regime"),
        weather_functions.regime(rules.SAFETY_REGIME_ORDER).alias("safety_regime"),
        expected.alias("expected_outages"),
        field.expected_observations("ops_risk_score").alias("expected_observations"),
        total.alias("total_outages"),
        F.round(total / expected, 3).alias("observed_to_expected"),
    )


def state_weather(s, d):
    return marts.state_weather(_days(s, d))


def demand_weather(s, d):
    return marts.demand_weather(staging.demand(_raw_demand(s, d)), _demand_days(s, d))


def calendar_parts(s, d):
    orders = raw.read(s, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    period = calendar.month_to_period("day")
    return orders.select(
        "o_orderkey", "day",
        F.year("day").alias("year"), F.month("day").alias("month"),
        calendar.iso_week("day").alias("week_num"), calendar.day_of_week("day").alias("day_of_week"),
        calendar.day_name("day").alias("day_name"), calendar.is_weekend("day").alias("is_weekend"),
        calendar.month_short("day").alias("month_short"), calendar.month_long(F.month("day")).alias("month_long"),
        period.alias("period"), calendar.period_to_month(period).alias("period_month"),
        calendar.season(F.month("day")).alias("season"),
        calendar.season(F.nullif(F.month("day"), F.lit(1)), null_to_fall=True).alias("season_else_fall"),
        calendar.season(F.nullif(F.month("day"), F.lit(1))).alias("season_or_null"),
    )


def _grid_mart(s, d):
    """Grid mart over nodes scored by both centralities of the network."""
    nodes, edges = raw.grid_network(s, d)
    scores = scored_nodes(nodes, edges).withColumnRenamed("node", "node_id")
    scored = raw.grid_nodes(s, d).join(scores, "node_id")
    return marts.grid_operations(staging.grid_nodes(scored), raw.grid_edges(s, d))


def grid_operations(s, d):
    return marts.by_centrality(_grid_mart(s, d))


def generator_mix(s, d):
    return marts.generator_mix(staging.generators(raw.generators(s, d)))


def sales_by_sector(s, d):
    return marts.sales_by_sector(staging.retail_sales(raw.sales_long(s, d)))


def sales_staging(s, d):
    return staging.retail_sales(raw.sales_long(s, d))


def sales_melt(s, d):
    return raw.sales_long(s, d)


def edge_classes(s, d):
    return staging.grid_edges(raw.grid_edges(s, d))


def latest_fleet(s, d):
    return summaries.fleet_capacity(filters.latest_period(raw.generators(s, d), "period"))


def seasonal(s, d):
    return summaries.seasonal_summary(_daily(s, d))


def grid_by_city(s, d):
    mart = _grid_mart(s, d)
    return summaries.cities_with_grid(summaries.ranked_cities(_daily(s, d)), summaries.grid_by_city(mart))


def high_stress_days(s, d):
    return summaries.high_stress_days(_daily(s, d))


def high_stress_topk(s, d):
    return summaries.top_high_stress_days(_daily(s, d))


def monthly_risk(s, d):
    return summaries.monthly_risk(_weather_mart(s, d))


def value_counts(s, d):
    return rollups.value_counts(raw.outages(s, d), "city", "cause")


def totals(s, d):
    spend = raw.spend(s, d)
    name = lambda df, dim: df.select(F.lit(dim).alias("dimension"), F.col(dim).alias("member"), "total_amount_usd")
    grand = rollups.totals_by(spend, "amount_usd").select(
        F.lit("all").alias("dimension"), F.lit("all").alias("member"), "total_amount_usd"
    )
    by = [name(rollups.totals_by(spend, "amount_usd", dim), dim) for dim in ("city", "asset_type")]
    return reshape.stack_by_name([grand, *by])


def column_profile(s, d):
    return rollups.profile(raw.read(s, d, "events"), "value")


def newest_periods(s, d):
    return rollups.distinct_values(raw.sales_wide(s, d), "period", newest=10)


def crosstab(s, d):
    spend = raw.spend(s, d)
    return measures.matrix(spend, "city", "spend_month", range(1, 13), exact_sum("amount_usd"))


def dashboard_measures(s, d):
    placed = raw.written_orders(s, d)
    daily = materialize(_daily(s, d, placed))
    return reshape.stack_by_name([
        measures.as_rows(measures.stress(daily, elevated_from=4), "stress"),
        measures.as_rows(measures.outages(daily), "outages"),
        measures.as_rows(measures.spend(marts.om_spend_mart(staging.om_spend(raw.spend(s, d, placed)))), "spend"),
        measures.as_rows(measures.workforce(marts.workforce_kpis(staging.workforce(raw.workforce(s, d, placed)))), "workforce"),
        measures.as_rows(measures.safety(marts.safety_kpis(staging.safety(raw.safety(s, d, placed)))), "safety"),
        measures.as_rows(measures.market(sales_staging(s, d)), "market"),
    ])


def charts(s, d):
    """The labour charts of the workforce board: by month and crew type, by city, and by weather risk, from one scan."""
    kpis = marts.workforce_kpis(staging.workforce(raw.workforce(s, d)))
    boards = {"month": ("year", "month_num", "crew_type"), "city": ("city_name",), "weather": ("weather_risk_score",)}
    return measures.charts(kpis, {"total_labor_cost": exact_sum("labor_cost"), "shifts": F.count("*")}, boards)


def quality_report(s, d):
    return contracts.report({
        "mart_weather_operations": _weather_mart(s, d),
        "mart_eia_weather": demand_weather(s, d),
        "mart_generator_mix": generator_mix(s, d),
        "mart_eia_sales_by_sector": sales_by_sector(s, d),
    })


def dropna_coerce(s, d):
    events = raw.read(s, d, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").alias("k"),
        F.regexp_extract("props", r'"k": (\d)\d}', 1).alias("tens"),
    )
    return filters.drop_missing(events.select("event_id", to_number("k").alias("k"), to_number("tens").alias("tens"),
                                              to_number("event_type").alias("not_a_number")), ["k", "tens"])


def degree_centrality(s, d):
    nodes, edges = raw.supply_network(s, d)
    return graph.degree_centrality(edges, nodes).withColumn("degree_centrality", F.round("degree_centrality", 8))


def top_hubs(s, d):
    nodes, edges = raw.supply_network(s, d)
    hubs = graph.degree_centrality(edges, nodes).withColumn("degree_centrality", F.round("degree_centrality", 8))
    return filters.top_k(hubs, 5, F.desc("degree_centrality"), F.asc("node"))


def network_counts(s, d):
    nodes, edges = raw.supply_network(s, d)
    return graph.counts(edges, nodes)


def components(s, d):
    nodes, edges = raw.shipment_network(s, d)
    return graph.connected_components(edges, nodes)


def node_removal(s, d):
    """Islands of the grid when its best connected node fails."""
    nodes, edges = raw.grid_network(s, d)
    hub = filters.top_k(graph.degree_centrality(edges, nodes), 1, F.desc("degree"), F.asc("node"))
    return graph.islands_without(edges, nodes, materialize(hub.select("node")))


def shortest_distances(s, d):
    _, edges = raw.supply_network(s, d)
    return graph.shortest_distances(edges, -1)


def shortest_path(s, d):
    _, edges = raw.grid_network(s, d)
    return graph.shortest_path(edges, "S0", "S7")


def betweenness(s, d):
    return _grid_mart(s, d).select(
        "node_id", "city", "degree_centrality", "betweenness_centrality", "criticality_tier", "is_major_hub",
        "connected_lines", "network_importance_score",
    )


def cause_mix(s, d):
    """Share of outage causes inside each weather regime."""
    days = _weather_mart(s, d).select("weather_date", "city_name", weather_functions.regime().alias("regime"))
    rows = joins.with_context(
        staging.outages(raw.outages(s, d)), days, {"outage_date": "weather_date", "city_name": "city_name"}, ["regime"]
    )
    return rollups.mix_within(rows.withColumn("regime", F.coalesce("regime", F.lit("no weather"))), "regime", "outage_cause")


def coverage_gaps(s, d):
    """City-months without spend on an asset and cost category."""
    spend = raw.spend(s, d)
    months = spend.select("city", "spend_year", "spend_month").distinct()
    expected = joins.expand_with(months, {"asset_type": list(rules.ASSET_MULTIPLIER), "cost_category": list(rules.CATEGORY_MULTIPLIER)})
    return joins.coverage_gaps(expected, spend, ["city", "spend_year", "spend_month", "asset_type", "cost_category"])


def staffing_gap(s, d):
    """Crews at work against crews required for the day's weather risk."""
    crews = marts.daily_workforce(marts.workforce_kpis(staging.workforce(raw.workforce(s, d))))
    joined = joins.with_context(
        _weather_mart(s, d), crews, {"weather_date": "summary_date", "city_name": "city_name"}, ["total_crews_deployed"]
    )
    required = field.required_crews("city_name", "ops_risk_score", base=REGION_CREWS)
    deployed = F.coalesce("total_crews_deployed", F.lit(0))
    return joined.select(
        "weather_date", "city_name", required.alias("required_crews"), deployed.alias("deployed_crews"),
        (deployed - required).alias("crew_gap"),
    )


def spend_normalised(s, d):
    """Spend with the asset, category and risk multipliers taken out."""
    return raw.spend(s, d).select(
        "spend_id", field.risk_multiplier("avg_risk_score").alias("risk_multiplier"),
        field.base_amount("amount_usd", "asset_type", "cost_category", "avg_risk_score").alias("base_amount"),
    )


def date_window(s, d):
    orders = filters.relative_window(raw.read(s, d, "orders"), "o_orderdate", AS_OF)
    orders = filters.facets(orders, o_orderstatus=["F", "O"])
    orders = filters.except_value(orders, "o_orderpriority", "3-MEDIUM")
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority")


def json_records(s, d):
    """Events landed as API pages of a thousand records in the checkpoint folder, read back as records."""
    events = raw.read(s, d, "events")
    record = F.struct("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    pages = events.groupBy(F.floor(F.col("event_id") / 1000).alias("offset")).agg(F.collect_list(record).alias("data"))
    total = events.agg(F.count("*")).scalar().cast("string")
    folder = session.scratch_path(s)
    pages.select("offset", F.struct(total.alias("total"), "data").alias("response")).write.partitionBy("offset").json(folder)
    landed = readers.landed_pages(s, folder, "event_id bigint, event_type string, k string")
    return readers.page_records(landed).select("event_id", "event_type", to_number("k").alias("k"))


def concat_sources(s, d):
    """Accounts of suppliers and customers, and orders from a source without any: lines stand in where no order is large."""
    accounts = reshape.stack_by_name([
        raw.read(s, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("amount")),
        raw.read(s, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount")),
    ])
    orders = raw.read(s, d, "orders").filter("o_totalprice < 0").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    parts = raw.read(s, d, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("amount"))
    return reshape.stack_by_name([filters.first_non_empty(accounts, parts), filters.first_non_empty(orders, parts)])


def label_join(s, d):
    """Customers by nation label from a table that lacks one region; the code stays where there is no label."""
    labels = raw.read(s, d, "nation").filter(F.col("n_regionkey") != 4).select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    customers = raw.read(s, d, "customer").withColumn("code", F.col("c_nationkey").cast("string"))
    labelled = joins.with_labels(customers, labels, "code", "n_name", "nation_label")
    return labelled.select(
        "c_custkey", "nation_label", text_or_empty(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("segment_text")
    )


def peak_months(s, d):
    """Months whose order value is the highest of their priority."""
    months = materialize(raw.sales_wide(s, d).select("sectorName", "period", "sales"))
    return ordered.group_peak_flag(months, "sales", "is_peak", ["sectorName"])


def count_measures(s, d):
    """High-stress day count and conditional counts by city."""
    return _daily(s, d).groupBy("city_name").agg(
        count_if(F.col("operational_stress_score") >= 7).alias("high_stress_days"),
        count_if(F.col("ops_risk_label") == "Monitor").alias("monitor_days"),
        exact_avg("labor_cost_per_outage").alias("avg_labor_cost_per_outage"),
    )


PAGE_RECORDS = 5000


def _land(records: DataFrame, number: str, folder: str) -> None:
    """Write records as API pages, one file each; the first page is landed twice, and one page is broken."""
    spark, slot = records.sparkSession, F.floor(F.col(number).cast("bigint") / PAGE_RECORDS)
    pages = records.groupBy(slot.alias("page")).agg(F.collect_list(F.struct(*records.columns)).alias("data"))
    total = records.agg(F.count("*")).scalar().cast("string")
    pages = materialize(pages.select("page", F.struct(total.alias("total"), "data").alias("response")))
    first = pages.agg(F.min("page")).scalar()
    for each in (pages, pages.filter(F.col("page") == first)):
        each.select("response").write.mode("append").option("maxRecordsPerFile", 1).json(folder)
    spark.createDataFrame([("no page {",)], "value string").write.mode("append").text(folder)


def _landed_events(s, d):
    """Events landed and ingested; the raw folder, completeness and bad pages."""
    landed, kept = session.scratch_path(s), session.scratch_path(s)
    hours = raw.read(s, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("string").alias("period"), (F.col("value") * 15).cast("string").alias("value")
    )
    _land(hours, "event_id", f"{landed}/demand")
    source = dataclasses.replace(ingest.SOURCES[0], record=f"{schemas.DEMAND_RECORD}, event_id string", key=("event_id",))
    return kept, *ingest.ingest(s, landed, kept, (source,))


def landed_demand(s, d):
    """Daily demand of events that were landed as pages."""
    kept, _, _ = _landed_events(s, d)
    return staging.demand(readers.table(s, kept, "raw_eia_demand").drop("created_at"))


def page_report(s, d):
    """Records found and announced, and pages without records."""
    _, complete, bad = _landed_events(s, d)
    return complete.withColumn("bad_pages", bad.agg(F.count("*")).scalar())


def landed_generators(s, d):
    """Generators landed as pages, their columns found by name."""
    landed, kept = session.scratch_path(s), session.scratch_path(s)
    made = raw.generators(s, d)
    text = lambda source, name: F.col(source).cast("string").alias(name)
    records = made.select(
        F.date_format("period", "yyyy-MM").alias("period"), text("state", "stateid"), text("plant_name", "plantName"),
        text("generator_id", "generatorid"), "energy_source_code", "technology",
        text("net_summer_capacity_mw", "net-summer-capacity-mw"), text("nameplate_capacity_mw", "nameplate-capacity-mw"),
    )
    _land(records, "generatorid", f"{landed}/generators")
    ingest.ingest(s, landed, kept, ingest.SOURCES[1:2])
    return staging.generators(readers.table(s, kept, "raw_eia_generators").drop("created_at", "latitude", "longitude"))


def weather_csv(s, d):
    """Weather written and read as CSV files."""
    path = session.scratch_path(s)
    writers.write_csv(raw.weather(s, d), path)
    return staging.weather_days(readers.weather_csv(s, path))


def weather_pages(s, d):
    """Weather landed as pages of parallel arrays, one per city and year."""
    landed, kept = session.scratch_path(s), session.scratch_path(s)
    pages = raw.weather(s, d).groupBy("city", F.year("date").alias("year")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("date").cast("string").alias("time"), "temp_max_f", "temp_min_f", "precipitation_inches", "wind_speed_max_mph", "weather_code"
    ))).alias("days"))
    names = {
        "time": "time", "temp_max_f": "temperature_2m_max", "temp_min_f": "temperature_2m_min",
        "precipitation_inches": "precipitation_sum", "wind_speed_max_mph": "windspeed_10m_max", "weather_code": "weathercode",
    }
    page = F.struct(*(F.col(f"days.{a}").alias(b) for a, b in names.items())).alias("daily")
    pages.select("city", page).write.partitionBy("city").option("maxRecordsPerFile", 1).json(f"{landed}/weather")
    city = F.regexp_extract("request", "city=([^/]*)$", 1)
    source = dataclasses.replace(ingest.SOURCES[3], build=lambda days: readers.weather_days(days, city))
    ingest.ingest(s, landed, kept, (source,))
    return staging.weather_days(readers.table(s, kept, "raw_weather").drop("created_at"))


def published_export(s, d):
    """The typed city summary through a versioned table, a table of the catalog and a view, with a fixed label per city size."""
    folder, name = session.scratch_path(s), f"published_{uuid.uuid4().hex}"
    ranked = writers.city_summary_export(summaries.ranked_cities(_daily(s, d)))
    upper = ranked.toDF(*(c.upper() for c in ranked.columns))
    writers.replace_files(writers.stamped(upper), folder, "summary")
    writers.replace_files(writers.stamped(readers.table(s, folder, "summary").drop("created_at")), folder, "summary", ["risk_label"])
    writers.replace_table(readers.table(s, folder, "summary"), name, folder)
    writers.replace_view(readers.catalog_table(s, name), f"{name}_view")
    published = s.table(f"{name}_view").drop("created_at")
    s.sql(f"DROP VIEW {name}")
    labels = readers.literal_table(s, [(1, "first"), (2, "second")], "stress_rank int, place string")
    return published.join(labels, "stress_rank", "left").withColumn("place", F.coalesce("place", F.lit("later")))


def is_connected(s, d):
    """Whether the shipments and the grid are networks of one piece."""
    found = []
    for name, network in (("shipments", raw.shipment_network), ("grid", raw.grid_network)):
        nodes, edges = network(s, d)
        parts = materialize(graph.connected_components(edges, nodes).select("component"))
        found.append(parts.agg(F.count_distinct("component").alias("islands")).select(
            F.lit(name).alias("network"), "islands", F.lit(graph.is_connected(parts)).alias("connected")
        ))
    return reshape.stack_by_name(found)


def state_trends(s, d):
    """Monthly changes of orders by status and priority, two kinds of states of their own."""
    months = raw.read(s, d, "orders").groupBy("o_orderstatus", "o_orderpriority", F.trunc("o_orderdate", "month").alias("month")).agg(
        F.count("*").alias("orders"), exact_sum("o_totalprice").alias("total")
    )
    changes = {"orders_mom": ("orders", 1), "orders_yoy": ("orders", 12), "total_yoy": ("total", 12)}
    return ordered.lag_changes(months, ["o_orderstatus", "o_orderpriority"], ["month"], changes).withColumns(
        {c: F.round(c, 2) for c in ("total", "total_yoy")}
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_ops_summary_ranked": ops_summary_ranked,
    "q02_ops_summary_daily": ops_summary_daily,
    "q03_daily_demand": daily_demand,
    "q04_spend_bands": spend_bands,
    "q05_generator_bands": generator_bands,
    "q06_weather_days": weather_days,
    "q07_outages_operations": outages_operations,
    "q08_safety_operations": safety_operations,
    "q09_workforce_operations": workforce_operations,
    "q10_weather_regime": weather_regime,
    "q11_demand_weather": demand_weather,
    "q12_calendar_parts": calendar_parts,
    "q13_grid_operations": grid_operations,
    "q14_generator_mix": generator_mix,
    "q15_sales_by_sector": sales_by_sector,
    "q16_edge_classes": edge_classes,
    "q17_latest_fleet": latest_fleet,
    "q18_seasonal": seasonal,
    "q19_grid_by_city": grid_by_city,
    "q20_high_stress_topk": high_stress_topk,
    "q21_monthly_risk": monthly_risk,
    "q22_value_counts": value_counts,
    "q23_totals": totals,
    "q24_column_profile": column_profile,
    "q25_crosstab": crosstab,
    "q26_dashboard_measures": dashboard_measures,
    "q27_charts": charts,
    "q28_quality_report": quality_report,
    "q29_dropna_coerce": dropna_coerce,
    "q30_degree_centrality": degree_centrality,
    "q31_components": components,
    "q32_node_removal": node_removal,
    "q33_shortest_distances": shortest_distances,
    "q34_shortest_path": shortest_path,
    "q35_betweenness": betweenness,
    "q36_cause_mix": cause_mix,
    "q37_coverage_gaps": coverage_gaps,
    "q38_staffing_gap": staffing_gap,
    "q39_date_window": date_window,
    "q40_json_records": json_records,
    "q41_concat_sources": concat_sources,
    "q42_label_join": label_join,
    "q43_sales_melt": sales_melt,
    "q44_sales_pivot": sales_staging,
    "q45_state_weather": state_weather,
    "q46_high_stress_days": high_stress_days,
    "q47_newest_periods": newest_periods,
    "q48_peak_months": peak_months,
    "q49_top_hubs": top_hubs,
    "q50_network_counts": network_counts,
    "q51_spend_normalised": spend_normalised,
    "q52_weather_staging": weather_staging,
    "q53_city_counts": count_measures,
    "q54_landed_demand": landed_demand,
    "q55_page_report": page_report,
    "q56_weather_csv": weather_csv,
    "q57_weather_pages": weather_pages,
    "q58_landed_generators": landed_generators,
    "q59_published_export": published_export,
    "q60_is_connected": is_connected,
    "q61_state_trends": state_trends,
}
