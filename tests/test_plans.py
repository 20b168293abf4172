"""Marts on hand-written rows, the whole refresh, and registered queries against their SQL."""

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from opsmart import schemas
from opsmart.plans import contracts, ingest, marts, measures, refresh, staging, summaries
from opsmart.sources import readers

DAY = dt.date(2026, 6, 20)


@pytest.fixture(scope="module")
def raw_folder(spark, tmp_path_factory):
    """All raw tables with a few rows."""
    folder = str(tmp_path_factory.mktemp("raw"))
    later = DAY + dt.timedelta(days=1)
    stamp = dt.datetime(2026, 1, 1)
    tables = {
        "raw_weather": [(DAY, "Denver", 100.0, 31.0, 0.6, 50.0, 95.0), (later, "Denver", 70.0, 60.0, None, 10.0, 0.0),
                        (DAY, "Fort_Collins", 80.0, 60.0, 0.0, 10.0, 2.0)],
        "raw_outages": [(1, DAY, "Denver", "C1", "Wind Damage", 2.0, 1000, 4), (2, DAY, "Denver", "C1", "Planned Outage", 20.0, 9000, 4),
                        (3, DAY, "Nowhere", "C9", "Unknown", 1.0, 10, 0), (4, later, "Denver", "C1", "Unknown", 0.5, 100, 0)],
        "raw_safety": [(1, DAY, "Denver", "DE-CREW-01", "Lineman", "Incident", "Critical", "Heat Stress", 15, 4, "Summer"),
                       (2, DAY, "Denver", "DE-CREW-02", "Engineer", "Positive Observation", "Low", "Team", 2, 4, "Summer")],
        "raw_workforce": [(1, DAY, "Denver", "DE-CREW-01", "Lineman", "Storm Restoration", 10.0, 1, 50.0, 750.0, 4),
                          (2, DAY, "Denver", "DE-CREW-02", "Engineer", "Training", 8.0, 0, 60.0, 480.0, 4)],
        "raw_om_spend": [(1, 2026, 6, "Denver", "Substation", "Labor", 25000.0, 0.0), (2, 2026, 6, "Denver", "Power Line", "Labor", 100.0, 4.0)],
        "raw_eia_demand": [(DAY, "PSCO", "x", 100.0, 7000.0, 50.0, 10.0, 24, "Critical Peak", "Saturday", 1, 6, 2026, stamp)],
        "raw_eia_generators": [(dt.date(2026, 6, 1), "CO", "p", "1", "NG", "Natural Gas", "t", 50.0, 100.0, 1.0, 1.0, stamp),
                               (dt.date(2026, 6, 1), "CO", "p", "2", "WND", "Wind", "t", 33.3, 40.0, 1.0, 1.0, stamp),
                               (dt.date(2026, 6, 1), "CO", "p", "3", "LIG", "LIG", "t", 16.7, 0.0, 1.0, 1.0, stamp)],
        "raw_eia_supply_disposition": [("2026-01", "CO", "Colorado", "RES", "r", "sales", 2.0, "", stamp), ("2026-02", "CO", "Colorado", "RES", "r", "sales", 3.0, "", stamp)],
        "raw_grid_nodes": [("A", "Hub", "Denver", 345, 100, 1.0, 1.0, 0.5, 0.6, stamp), ("B", "Sub", "Fort Collins", 115, 0, 1.0, 1.0, 0.1, 0.0, stamp)],
        "raw_grid_edges": [("A", "B", 10, 500, "T", stamp), ("A", "B", 20, 700, "T", stamp), ("B", "A", 40, 100, "D", stamp)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, schemas.RAW_TABLES[name]).write.parquet(f"{folder}/{name}")
    return folder


@pytest.fixture(scope="module")
def built(spark, raw_folder, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("marts"))
    assert len(refresh.refresh(spark, raw_folder, folder)) == 12
    return lambda name: readers.table(spark, folder, name)


def test_weather_and_summary(built):
    weather = built("mart_weather_operations").filter((F.col("city_name") == "Denver") & (F.col("weather_date") == DAY)).first()
    assert (weather["ops_risk_score"], weather["ops_risk_label"], weather["temp_avg_f"], weather["season"]) == (4, "High Alert", 65.5, "Summer")
    daily = {(r["summary_date"], r["city_name"]): r for r in built("mart_operations_summary").collect()}
    assert len(daily) == 3
    busy = daily[DAY, "Denver"]
    assert (busy["total_outages"], busy["max_outage_severity"], busy["unplanned_outages"], busy["avg_outage_duration_hrs"]) == (2, 5, 1, 11.0)
    assert (busy["total_labor_cost"], busy["total_overtime_cost"], busy["labor_cost_per_outage"]) == (1230.0, 250.0, 615.0)
    assert (busy["incident_rate_per_crew"], busy["avg_severity_score"], busy["operational_stress_score"]) == (0.5, 2.5, 13.5)
    assert (busy["overdue_closures"], busy["positive_observations"], busy["max_safety_risk_index"]) == (1, 1, 20.0)
    quiet = daily[DAY + dt.timedelta(days=1), "Denver"]
    assert (quiet["total_outages"], quiet["labor_cost_per_outage"], quiet["total_crews_deployed"]) == (1, None, 0)
    calm = daily[DAY, "Fort_Collins"]
    assert (calm["total_outages"], calm["labor_cost_per_outage"], calm["operational_stress_score"]) == (0, 0.0, 0.0)


def test_detail_marts_keep_rows(built):
    outages = built("mart_outages_operations")
    assert outages.count() == 4
    assert outages.filter("city_name = 'Nowhere'").first()["temp_max_f"] is None
    assert built("mart_safety_operations").count() == 2 and built("mart_workforce_operations").count() == 2


def test_energy_marts(built):
    row = built("mart_eia_weather").first()
    assert (row["dominant_weather"], row["temp_avg_f"], row["cooling_degree_days"], row["heating_degree_days"]) == ("Partly Cloudy", 67.8, 2.8, 0.0)
    assert (row["mwh_per_cooling_degree"], row["mwh_per_heating_degree"], row["operational_condition"]) == (2500.0, None, "Grid Critical")
    mix = {r["fuel_type"]: r for r in built("mart_generator_mix").collect()}
    assert [(mix[f]["fleet_share_pct"], mix[f]["cumulative_share_pct"]) for f in ("Natural Gas", "Wind", "LIG")] == [(50.0, 50.0), (33.3, 83.3), (16.7, 100.0)]
    assert mix["LIG"]["avg_efficiency_pct"] is None and mix["Wind"]["grid_dependency_label"] == "Critical Dependency"
    sales = [r for r in built("mart_eia_sales_by_sector").orderBy("sale_month").collect()]
    assert [r["sales_mwh_mom_change"] for r in sales] == [None, 1000.0] and [r["is_sector_peak_month"] for r in sales] == [0, 1]


def test_grid_mart(built):
    grid = {r["node_id"]: r for r in built("mart_grid_operations").collect()}
    assert (grid["A"]["connected_lines"], grid["A"]["avg_line_distance_miles"], grid["A"]["throughput_ratio_pct"]) == (3, 27.5, 1300.0)
    assert grid["B"]["throughput_ratio_pct"] is None and grid["A"]["criticality_tier"] == "Critical"


def test_city_tables(built):
    ranked = {r["city_name"]: r for r in built("raw_spark_city_summary").collect()}
    assert (ranked["Denver"]["stress_rank"], ranked["Fort_Collins"]["stress_rank"], ranked["Denver"]["risk_label"]) == (1, 2, "High Risk")
    assert len(built("raw_spark_city_summary").columns) == 13
    assert {r["city_name"]: r["facility_count"] for r in built("city_grid_summary").collect()} == {"Denver": 1, "Fort_Collins": 1}


def test_summaries_and_measures(built):
    daily = built("mart_operations_summary")
    assert summaries.high_stress_days(daily).count() == 1
    assert summaries.high_stress_days(daily, threshold=1).count() == 2
    assert summaries.top_high_stress_days(daily, k=1).first()["operational_stress_score"] == 13.5
    assert summaries.seasonal_summary(daily).first()["total_days"] == 3
    stress = measures.stress(daily).first()
    assert (stress["peak_stress_score"], stress["high_stress_days"], stress["high_risk_day_share"]) == (13.5, 1, 0.0)
    assert measures.stress(daily, high_label="High Alert").first()["high_risk_day_share"] == 1 / 3
    assert measures.stress(daily.filter("1 = 0")).first()["high_risk_day_share"] == 0.0


def test_declared_column_tests(built):
    report = contracts.report({name: built(name) for name in contracts.MART_TESTS})
    failed = {(r["table_name"], r["column_name"], r["severity"]) for r in report.filter("NOT passed").collect()}
    assert report.count() == 45
    assert failed == {("mart_eia_sales_by_sector", "price_cents_per_kwh", "warn")}


def test_staging_views(spark, raw_folder):
    refresh.staging_views(spark, raw_folder)
    assert spark.sql("SELECT weather_description FROM stg_weather WHERE weather_code = 95").first()[0] == "Thunderstorm"
    assert spark.sql("SELECT count(*) FROM stg_workforce").first()[0] == 2


def test_state_weather_of_unknown_temperatures(spark):
    days = spark.createDataFrame([(DAY, "a", None, None, None, None, None)], schemas.RAW_WEATHER)
    row = marts.state_weather(staging.weather_days(days)).first()
    assert (row["cooling_degree_days"], row["heating_degree_days"], row["dominant_weather"]) == (None, None, "Unknown")


def test_bundled_table_reader(spark, raw_folder):
    assert readers.table(spark, raw_folder, "raw_weather").columns[0] == "date"


@pytest.mark.parametrize("name", ["q01_ops_summary_ranked", "q14_generator_mix", "q15_sales_by_sector", "q31_components", "q33_shortest_distances"])
def test_registered_queries_match_their_sql(spark, name):
    from checks.compare import database, differences
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, folder)
    cursor = database(folder).execute(ORACLE[name])
    assert differences(df.columns, df.collect(), [c[0] for c in cursor.description], cursor.fetchall()) == []
    assert set(ORACLE) == set(QUERIES)


def test_trends_stay_within_a_state(spark):
    rows = [
        ("2026-01", "CO", "RES", 100.0), ("2026-02", "CO", "RES", 110.0), ("2026-01", "UT", "RES", 5000.0), ("2026-02", "UT", "RES", 4000.0)
    ]
    raw = spark.createDataFrame(
        [(p, st, st, s, s, "sales", v, "") for p, st, s, v in rows],
        "period string, state_id string, state_name string, sector string, sector_name string, data_type string, value double, unit string")
    staged = staging.retail_sales(raw).cache()
    trend = marts.sales_by_sector(staged.withColumn("state_name", F.col("state_id")))
    got = {(round(r["sales_mwh"]), r["is_sector_peak_month"]): r["sales_mwh_mom_change"] for r in trend.collect()}
    assert got == {(100_000, 0): None, (110_000, 1): 10_000.0, (5_000_000, 1): None, (4_000_000, 0): -1_000_000.0}


def test_from_landed_pages_to_tested_marts(spark, raw_folder, tmp_path):
    def land(source, name, rows, total):
        folder = tmp_path / "landed" / source
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(json.dumps({"response": {"total": total, "data": rows}}))

    raw, built = tmp_path / "raw", tmp_path / "marts"
    shutil.copytree(raw_folder, raw)
    land("demand", "1.json", [{"period": f"2026-06-20T{h:02d}", "value": str(5000 + h)} for h in range(3)], "4")
    land("demand", "2.json", [{"period": "2026-06-20T05", "value": "NaN"}], "4")
    (tmp_path / "landed" / "demand" / "3.json").write_text("no json {")
    plant = {"period": "2026-06", "plantName": "P", "generatorid": "1", "technology": "t", "nameplate-capacity-mw": "100"}
    land("generators", "1.json", [plant | {"energy_source_code": "NG", "net-summer-capacity-mw": "90"}], "2")
    sale = {"period": "2026-01", "stateid": "CO", "sales": "2", "price": "10", "customers": "5", "revenue": "1"}
    land("sales", "1.json", [sale | {"sector": s, "typeName": s} for s in ("RES", "COM")], "2")
    complete, bad = ingest.ingest(spark, str(tmp_path / "landed"), str(raw))
    assert {r["table_name"]: (r["fetched"], r["complete"]) for r in complete.collect()} == {
        "raw_eia_demand": (4, True), "raw_eia_generators": (1, False), "raw_eia_supply_disposition": (2, True)}
    assert [r["page"].rsplit("/", 1)[1] for r in bad.collect()] == ["3.json"]
    nodes, edges = (readers.table(spark, str(raw), n).drop("created_at") for n in ("raw_grid_nodes", "raw_grid_edges"))
    ingest.build_network(nodes.drop("degree_centrality", "betweenness_centrality"), edges, str(raw))
    report = ingest.refresh_checked(spark, str(raw), str(built))
    assert report.count() == sum(map(len, contracts.MART_TESTS.values()))
    demand = readers.table(spark, str(built), "mart_eia_weather").first()
    assert (demand["total_demand_mwh"], demand["peak_demand_mwh"], demand["load_tier"]) == (15003.0, 5002.0, "Moderate Load")
    ranked = readers.table(spark, str(built), "raw_spark_city_summary").collect()
    assert {r["city_name"] for r in ranked} == {"Denver", "Fort_Collins"}
    land("demand", "2.json", [{"period": "2026-06-21T05", "value": "x"}], "4")
    ingest.ingest(spark, str(tmp_path / "landed"), str(raw), ingest.SOURCES[:1])
    with pytest.raises(ValueError, match="not_null of mart_eia_weather.total_demand_mwh"):
        ingest.refresh_checked(spark, str(raw), str(built))
    still = readers.table(spark, str(built), "mart_eia_weather")  # nothing was published
    assert still.count() == 1 and still.first()["created_at"] == demand["created_at"]


def test_each_landed_record_counts_once(spark, tmp_path):
    """A page landed twice, a rerun, a late page and a corrected page; totals stay those of the records."""
    landed, raw = tmp_path / "landed", tmp_path / "raw"

    def land(folder, name, rows, total):
        (landed / folder).mkdir(parents=True, exist_ok=True)
        (landed / folder / name).write_text(json.dumps({"response": {"total": total, "data": rows}}))

    hour = lambda h, v=1000: {"period": f"2026-06-20T{h:02d}", "value": str(v)}
    run = lambda **k: {r["table_name"]: (r["fetched"], r["announced"], r["complete"]) for r in ingest.ingest(spark, str(landed), str(raw), ingest.SOURCES[:1], **k)[0].collect()}
    day = lambda: [(r["total_demand_mwh"], r["hours_reported"]) for r in readers.table(spark, str(raw), "raw_eia_demand").collect()]
    land("demand", "1.json", [hour(0), hour(1)], "4")
    land("demand", "1-again.json", [hour(0), hour(1)], "4")
    assert run() == {"raw_eia_demand": (2, 4, False)} and not (raw / "raw_eia_demand.versions").exists()
    assert run(publish_incomplete=True) == {"raw_eia_demand": (2, 4, False)} and day() == [(2000.0, 2)]
    land("demand", "2.json", [hour(1), hour(2), hour(3)], "4")  # late, and it repeats an hour
    for _ in range(2):
        assert run() == {"raw_eia_demand": (4, 4, True)} and day() == [(4000.0, 4)]
    taken = spark.read.parquet(f"{raw}/_taken/raw_eia_demand/pages")
    assert taken.count() == 3
    land("demand", "2.json", [hour(2), hour(3, 5000)], "4")  # the page is corrected
    assert run() == {"raw_eia_demand": (4, 4, True)} and day() == [(8000.0, 4)]
    (landed / "demand" / "2.json").write_text("{ broken")
    complete, bad = ingest.ingest(spark, str(landed), str(raw), ingest.SOURCES[:1])
    assert [(r["fetched"], r["complete"]) for r in complete.collect()] == [(2, False)] and day() == [(8000.0, 4)]
    assert [r["_corrupt_record"] for r in bad.collect()] == ["{ broken"]


def test_fallback_and_weather_pages(spark, tmp_path):
    landed, raw = tmp_path / "landed", tmp_path / "raw"
    sales, weather = ingest.SOURCES[2:]
    sale = lambda state, sector: {"period": "2026-01", "stateid": state, "sectorid": sector, "sectorName": sector, "typeName": sector, "sales": "2"}
    for folder, data in (("sales", []), ("sales_fallback", [sale("CO", "RES"), sale("CO", "COM")])):
        (landed / folder).mkdir(parents=True)
        (landed / folder / "1.json").write_text(json.dumps({"response": {"total": len(data), "data": data}}))
    days = {"time": ["2026-06-20", "2026-06-21"], "temperature_2m_max": [90.0, None], "temperature_2m_min": [60.0, 55.0],
            "precipitation_sum": [0.0, 0.1], "windspeed_10m_max": [10.0, 12.0], "weathercode": [1, 2]}
    for city in ("Denver", "Pueblo"):
        (landed / "weather" / city).mkdir(parents=True)
        (landed / "weather" / city / "1.json").write_text(json.dumps({"daily": days}))
    complete, _ = ingest.ingest(spark, str(landed), str(raw), (sales, weather))
    assert {tuple(r)[:4] for r in complete.collect()} == {("raw_eia_supply_disposition", 2, 2, True), ("raw_weather", 4, None, True)}
    assert {r["sector"] for r in readers.table(spark, str(raw), "raw_eia_supply_disposition").collect()} == {"RES", "COM"}
    rows = readers.table(spark, str(raw), "raw_weather").drop("created_at")
    assert sorted(map(tuple, rows.collect()), key=str)[0] == (DAY, "Denver", 90.0, 60.0, 0.0, 10.0, 1.0)
    assert staging.weather_days(rows).count() == 4
    (landed / "sales" / "2.json").write_text(json.dumps({"response": {"total": 1, "data": [sale("CO", "IND")]}}))
    ingest.ingest(spark, str(landed), str(raw), (sales,))
    assert {r["sector"] for r in readers.table(spark, str(raw), "raw_eia_supply_disposition").collect()} == {"IND"}
    with pytest.raises(ValueError, match="no page of demand"):
        ingest.ingest(spark, str(landed), str(raw), ingest.SOURCES[:1])


def test_state_means_keep_values_that_decimals_do_not_hold(spark):
    rows = [(DAY, "A", 2e26), (DAY, "B", 50.0), (DAY + dt.timedelta(days=1), "A", 1 / 3), (DAY + dt.timedelta(days=1), "B", float("nan"))]
    days = spark.createDataFrame(rows, "weather_date date, city_name string, temp_avg_f double").withColumns({
        **{c: F.lit(1.0) for c in ("temp_max_f", "temp_min_f", "wind_speed_max_mph", "precipitation_inches")}, "weather_description": F.lit("Clear"),
    })
    got = {r["weather_date"]: r["temp_avg_f"] for r in marts.state_weather(days).collect()}
    assert got == {DAY: 1e26, DAY + dt.timedelta(days=1): 0.3}
