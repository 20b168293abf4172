"""Landed files in, finished tables out."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opsmart import schemas
from opsmart.operators.filters import drop_missing, first_non_empty
from opsmart.operators.reshape import stack_by_name
from opsmart.plans import staging
from opsmart.sources import readers, writers


def put(folder, name, content):
    path = folder / name
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


def test_weather_csv(spark, tmp_path):
    put(tmp_path, "w.csv", "date,city,temp_max_f,temp_min_f,precipitation_inches,wind_speed_max_mph,weather_code\n2026-06-18,Denver,90.2,74.9,,13.6,0.0\n")
    row = readers.weather_csv(spark, f"{tmp_path}/w.csv").first()
    assert (str(row["date"]), row["temp_max_f"], row["precipitation_inches"], row["weather_code"]) == ("2026-06-18", 90.2, None, 0.0)


def test_parallel_arrays(spark, tmp_path):
    page = lambda shift: {"daily": {"time": ["2026-06-18", "2026-06-19"], "temperature_2m_max": [90.0 + shift, None], "temperature_2m_min": [70.0, 60.0],
                                    "precipitation_sum": [None, 0.1], "windspeed_10m_max": [10.0, 11.0], "weathercode": [0.0, 3.0]}}
    a, b = put(tmp_path, "a.json", page(0)), put(tmp_path, "b.json", page(5))
    both = stack_by_name([readers.weather_page(spark, a, "Denver"), readers.weather_page(spark, b, "Pueblo")])
    got = [tuple(r)[1:4] for r in drop_missing(both, ["temp_max_f", "temp_min_f"]).orderBy("city").collect()]
    assert got == [("Denver", 90.0, 70.0), ("Pueblo", 95.0, 70.0)]


def test_pages(spark, tmp_path):
    hours = [{"period": f"2026-01-01T{h:02d}", "value": str(6000 + h)} for h in range(3)]
    put(tmp_path, "p1.json", {"response": {"total": "4", "data": hours[:2]}})
    put(tmp_path, "p2.json", {"response": {"total": "4", "data": [hours[2], {"period": "2026-01-02T00", "value": "n/a"}]}})
    put(tmp_path, "p3.json", {"error": "quota"})
    put(tmp_path, "p4.json", "not json at all {")
    pages = readers.landed_pages(spark, str(tmp_path), schemas.DEMAND_RECORD)
    records = readers.page_records(pages)
    assert records.count() == 4
    assert tuple(readers.page_completeness(pages).first()) == (4, 4, True)
    bad = {r["page"].rsplit("/", 1)[1]: r["_corrupt_record"] is not None for r in readers.bad_pages(pages).collect()}
    assert bad == {"p3.json": False, "p4.json": True}
    daily = {str(r["date"]): r for r in staging.demand(staging.daily_demand(readers.hourly_demand(records)).withColumnRenamed("date", "date")).withColumnRenamed("demand_date", "date").collect()}
    first, second = daily["2026-01-01"], daily["2026-01-02"]
    assert (first["total_demand_mwh"], first["peak_demand_mwh"], first["hours_reported"], first["load_tier"]) == (18003.0, 6002.0, 3, "High Load")
    assert (first["is_high_load"], first["is_critical_peak"], first["day_of_week"], first["daily_demand_swing_mwh"]) == (1, 0, "Thursday", 2.0)
    assert (second["total_demand_mwh"], second["hours_reported"], second["load_tier"]) == (None, 0, "Normal Load")


def test_incomplete_pages(spark, tmp_path):
    put(tmp_path, "p.json", {"response": {"total": "9", "data": [{"period": "2026-01", "value": "1"}]}})
    pages = readers.landed_pages(spark, str(tmp_path), schemas.DEMAND_RECORD)
    assert tuple(readers.page_completeness(pages).first()) == (1, 9, False)


def test_repeated_page_does_not_hide_a_missing_one(spark, tmp_path):
    hours = [{"period": f"2026-01-01T{h:02d}", "value": str(h)} for h in range(4)]
    for name in ("p1.json", "p2.json"):
        put(tmp_path, name, {"response": {"total": "4", "data": hours[:2]}})
    pages = readers.landed_pages(spark, str(tmp_path), StructType.fromDDL(schemas.DEMAND_RECORD))
    assert tuple(readers.page_completeness(pages).first()) == (2, 4, False)
    put(tmp_path, "p3.json", {"response": {"total": "4", "data": hours[2:]}})
    again = readers.landed_pages(spark, str(tmp_path), "period string, value decimal(10,2)")
    assert tuple(readers.page_completeness(again).first()) == (4, 4, True)
    assert readers.page_records(again).agg({"value": "max"}).first()[0] == 3


def test_header_decides_and_second_endpoint(spark, tmp_path):
    (tmp_path / "w.csv").write_text("city,date,temp_max_f,temp_min_f,precipitation_inches,wind_speed_max_mph,weather_code\nDenver,2026-01-02,50,x,0,5,1\n")
    row = readers.weather_csv(spark, f"{tmp_path}/w.csv").first()
    assert (str(row["date"]), row["city"], row["temp_max_f"], row["temp_min_f"]) == ("2026-01-02", "Denver", 50.0, None)
    (tmp_path / "x.csv").write_text("city,date\nDenver,2026-01-02\n")
    with pytest.raises(ValueError, match="temp_max_f"):
        readers.weather_csv(spark, f"{tmp_path}/x.csv")
    other = tmp_path / "other"
    other.mkdir()
    put(other, "p.json", {"response": {"total": "2", "data": [
        {"period": "2026-01", "stateName": "Colorado", "sector": s, "typeName": s.lower(), "sales": "5"} for s in ("RES", "COM")]}})
    sales = readers.retail_sales(readers.page_records(readers.landed_pages(spark, str(other), schemas.SALES_RECORD)))
    assert {(r["sector"], r["sector_name"], r["state_id"]) for r in sales.collect()} == {("RES", "res", "CO"), ("COM", "com", "CO")}


def test_generator_records(spark, tmp_path):
    put(tmp_path, "g.json", {"response": {"total": 1, "data": [{
        "period": "2026-06", "plantName": "Comanche", "generatorid": "3", "energy_source_code": "SUB", "technology": "Steam",
        "net-summer-capacity-mw": "750", "nameplate-capacity-mw": "x", "latitude": "38.2", "longitude": "-104.5"}]}})
    raw = readers.generator_inventory(readers.page_records(readers.landed_pages(spark, str(tmp_path), schemas.GENERATOR_RECORD)))
    row = staging.generators(raw).first()
    assert (str(row["period"]), row["plant_name"], row["fuel_type"], row["net_summer_capacity_mw"]) == ("2026-06-01", "Comanche", "Subbituminous Coal", 750.0)
    assert (row["nameplate_capacity_mw"], row["capacity_efficiency_pct"], row["fuel_category"], row["is_dispatchable"]) == (None, None, "Coal", 0)


def test_sales_records_and_fallback(spark, tmp_path):
    empty, full = tmp_path / "a", tmp_path / "b"
    empty.mkdir(), full.mkdir()
    put(empty, "p.json", {"response": {"total": "0", "data": []}})
    record = lambda sector, **m: {"period": "2026-01", "stateid": "CO", "stateDescription": "Colorado", "sectorid": sector, "sectorName": sector.lower(), **m}
    put(full, "p.json", {"response": {"total": "3", "data": [
        record("RES", customers="100", revenue="2.5", sales="20", price="12.5", **{"sales-units": "million kWh"}),
        record("ALL", sales="99"), record("TRA", sales=None)]}})
    read = lambda folder: readers.page_records(readers.landed_pages(spark, str(folder), schemas.SALES_RECORD))
    raw = readers.retail_sales(first_non_empty(read(empty), read(full)))
    assert raw.count() == 12
    assert raw.filter("sector = 'RES' AND data_type = 'sales'").first()["unit"] == "million kWh"
    wide = {r["sector"]: r for r in staging.retail_sales(raw).collect()}
    assert set(wide) == {"RES", "TRA"}
    res = wide["RES"]
    assert (res["sales_mwh"], res["revenue_usd"], res["price_usd_per_kwh"], res["revenue_per_customer_usd"]) == (20000.0, 2500000.0, 0.125, 25000.0)
    assert (str(res["sale_month"]), res["month_name"], res["season"], wide["TRA"]["sales_mwh"]) == ("2026-01-01", "Jan", "Winter", None)


def test_sales_null_sector_is_dropped(spark):
    rows = [("2026-01", "CO", "Colorado", None, "x", "sales", 1.0, ""), ("2026-01", "CO", "Colorado", "COM", "c", "sales", 1.0, "")]
    raw = spark.createDataFrame(rows, "period string, state_id string, state_name string, sector string, sector_name string, data_type string, value double, unit string")
    assert [r["sector"] for r in staging.retail_sales(raw).collect()] == ["COM"]


def test_writers(spark, tmp_path):
    df = readers.literal_table(spark, [(2024, 1, "a"), (2024, 2, "b")], "year int, month_num int, NAME string")
    writers.replace_files(df, str(tmp_path), "t", ("year", "month_num"))
    path = writers.replace_files(df.filter("month_num = 2"), str(tmp_path), "t", ("year", "month_num"))
    assert [r["name"] for r in readers.table(spark, str(tmp_path), "t").collect()] == ["b"]
    assert os.path.isdir(f"{path}/year=2024/month_num=2") and path == writers.current_version(spark, str(tmp_path), "t")
    writers.write_csv(df, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").columns == ["year", "month_num", "NAME"]
    writers.replace_table(df, "opsmart_written", str(tmp_path))
    assert readers.catalog_table(spark, "opsmart_written").columns == ["year", "month_num", "name"]
    writers.replace_view(df, "opsmart_view")
    assert spark.sql("SELECT count(*) AS n FROM opsmart_view").first()["n"] == 2
    stamped = writers.stamped(df)
    assert stamped.select("created_at").distinct().count() == 1 and dict(stamped.dtypes)["created_at"] == "timestamp_ntz"


def test_interrupted_write_leaves_the_old_version(spark, tmp_path):
    df = readers.literal_table(spark, [(1,), (2,)], "a int")
    writers.replace_files(df, str(tmp_path), "t")
    broken = df.select(F.raise_error(F.lit("stop")).cast("int").alias("a"))
    with pytest.raises(Exception, match="stop"):
        writers.replace_files(broken, str(tmp_path), "t")
    assert readers.table(spark, str(tmp_path), "t").count() == 2
    writers.replace_files(df.filter("a = 2"), str(tmp_path), "t")  # the same folder is read and replaced
    writers.replace_files(readers.table(spark, str(tmp_path), "t"), str(tmp_path), "t")
    assert [r["a"] for r in readers.table(spark, str(tmp_path), "t").collect()] == [2]
    writers.replace_table(df, "opsmart_twice", str(tmp_path))
    open_before = readers.catalog_table(spark, "opsmart_twice")
    writers.replace_table(df.filter("a = 1").withColumn("b", F.lit("x")), "opsmart_twice", str(tmp_path))
    after = readers.catalog_table(spark, "opsmart_twice")
    assert after.count() == 1 and after.columns == ["a", "b"] and open_before.count() == 2


def test_versions_are_published_at_once_and_removed_by_age(spark, tmp_path):
    folder = str(tmp_path)
    df = readers.literal_table(spark, [(1,), (2,)], "a int")
    assert writers.current_version(spark, folder, "t") is None
    first = writers.replace_files(df, folder, "t")
    reader = readers.table(spark, folder, "t")
    unpublished = writers.write_version(df.filter("a = 2"), folder, "t")
    assert writers.current_version(spark, folder, "t") == first
    writers.publish(spark, unpublished)
    assert writers.current_version(spark, folder, "t") == unpublished and reader.count() == 2
    with pytest.raises(ValueError, match="published already"):
        writers.publish(spark, unpublished)
    left = writers.write_version(df, folder, "t")  # a run that stopped here
    assert writers.remove_old_versions(spark, folder, "t") == []
    assert len(writers.remove_old_versions(spark, folder, "t", hours=-1)) == 2
    assert not os.path.exists(first) and not os.path.exists(left) and readers.table(spark, folder, "t").count() == 1
    assert writers.remove_old_versions(spark, folder, "t", hours=-1) == []


def test_failing_steps_never_lose_the_last_version(spark, tmp_path, monkeypatch):
    """Whatever step fails, readers find the version before or the new one."""
    folder, df = str(tmp_path), readers.literal_table(spark, [(1,), (2,)], "a int")
    writers.replace_files(df, folder, "t")
    for step in ("write_version", "publish", "remove_old_versions"):
        with monkeypatch.context() as broken:
            real = getattr(writers, step)

            def fail(*a, real=real, late=step == "remove_old_versions", **k):
                if late:
                    real(*a, **k)
                raise OSError("stop")

            broken.setattr(writers, step, fail)
            with pytest.raises(OSError):
                writers.replace_files(df.filter("a = 1"), folder, "t")
        assert readers.table(spark, folder, "t").count() == (1 if step == "remove_old_versions" else 2)
