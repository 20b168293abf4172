"""Tables and landed files as DataFrames. Schemas are explicit: no inference pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .. import schemas
from ..functions.core import first_containing, first_filled_col, first_present_col, to_number
from ..functions.energy import fuel_type
from ..functions.calendar import period_to_month
from ..operators.filters import lower_names, present_columns
from ..operators.reshape import melt_with_units
from .. import rules
from .writers import current_version


def weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw weather table, columns found by their header; text of another type becomes NULL.

    A missing column is an error, and so is a file whose header differs from the others'.
    """
    rows = lower_names(spark.read.option("header", True).option("enforceSchema", False).csv(path))
    fields = StructType.fromDDL(schemas.RAW_WEATHER).fields
    if missing := [f.name for f in fields if f.name not in rows.columns]:
        raise ValueError(f"the header has no {', '.join(missing)}")
    return rows.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table below a folder, with lower-case column names: its newest version, or plain files of that name."""
    return lower_names(spark.read.parquet(current_version(spark, folder, name) or f"{folder.rstrip('/')}/{name}"))


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return lower_names(spark.table(name))


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small dimension written down in code."""
    return spark.createDataFrame(list(rows), schema)


# Paged API responses: one JSON document per file, records in response.data.
def landed_pages(spark: SparkSession, path: str | Sequence[str], record: str | StructType) -> DataFrame:
    """One row per page: its records, the announced total, and the text if the page is not JSON.

    ``record`` is a type or its DDL. The pages of one request lie in one folder, which is its ``request``.
    """
    record = StructType.fromDDL(record) if isinstance(record, str) else record
    response = StructType([StructField("total", StringType()), StructField("data", ArrayType(record))])
    envelope = StructType([StructField("response", response), StructField("_corrupt_record", StringType())])
    pages = (
        spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", "_corrupt_record").schema(envelope).json(path)
    )
    named = pages.withColumn("page", F.input_file_name())
    return named.withColumn("request", F.regexp_replace("page", "/[^/]*$", ""))


def page_records(pages: DataFrame) -> DataFrame:
    """Records of all good pages; pages without data give none."""
    return pages.select(F.explode("response.data").alias("r")).select("r.*")


def bad_pages(pages: DataFrame) -> DataFrame:
    """Pages that carry no record list: broken JSON, an error message or another layout."""
    return pages.filter(F.col("response.data").isNull()).select("page", "_corrupt_record")


def page_completeness(pages: DataFrame) -> DataFrame:
    """Different records fetched against the totals that the requests announce, one row.

    A record that was landed twice counts once, so a repeated page does not hide a missing one; ``complete``
    means that every request has exactly as many as it announced.
    """
    requests = pages.groupBy("request").agg(F.max(F.col("response.total").try_cast("long")).alias("announced"))
    records = pages.select(F.col("request").alias("__request"), F.explode("response.data").alias("record")).distinct()
    fetched = records.groupBy("__request").agg(F.count("*").alias("found"))
    each = requests.join(fetched, F.col("request") == F.col("__request"), "left").withColumn("found", F.coalesce("found", F.lit(0)))
    same = F.coalesce(F.col("found") == F.col("announced"), F.lit(False))
    return each.agg(
        F.coalesce(F.sum("found"), F.lit(0)).alias("fetched"), F.sum("announced").alias("announced"),
        F.coalesce(F.bool_and(same), F.lit(False)).alias("complete"),
    )


# Landed files taken once: what lies there, and the pages in files not taken yet.
def page_files(spark: SparkSession, path: str) -> DataFrame:
    """(page, modified, length) of all files below a folder, which may be missing. Contents are not read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "page string, modified timestamp, length bigint")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("page"), F.col("modificationTime").alias("modified"), "length")


def page_texts(spark: SparkSession, pages: Sequence[str]) -> DataFrame:
    """(page, request, modified, length, digest, text) of the named files. The folder of a page is its request."""
    files = spark.read.format("binaryFile").load(list(pages))
    return files.select(
        F.col("path").alias("page"), F.regexp_replace("path", "/[^/]*$", "").alias("request"),
        F.col("modificationTime").alias("modified"), "length", F.sha2("content", 256).alias("digest"),
        F.col("content").cast("string").alias("text"),
    )


def api_page(text: str, record: str) -> Column:
    """Announced total and records of a page in the column ``text``; no records where it is no such page."""
    kind = f"response struct<total: string, data: array<struct<{_fields(record)}>>>"
    page = F.from_json(text, kind)["response"]
    return F.struct(page["total"].try_cast("long").alias("total"), page["data"].alias("data"))


def _fields(record: str) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in StructType.fromDDL(record))


def _day_columns(daily: Column) -> Column:
    return F.arrays_zip(
        daily["time"].alias("time"), daily["temperature_2m_max"].alias("temp_max_f"), daily["temperature_2m_min"].alias("temp_min_f"),
        daily["precipitation_sum"].alias("precipitation_inches"), daily["windspeed_10m_max"].alias("wind_speed_max_mph"),
        daily["weathercode"].alias("weather_code"),
    )


def daily_page(text: str, record: str = schemas.DAILY_WEATHER) -> Column:
    """Days of a page of parallel arrays, one element per day. Such a page announces no total."""
    daily = F.from_json(text, schemas.DAILY_WEATHER_PAGE)["daily"]
    return F.struct(F.lit(None).cast("long").alias("total"), _day_columns(daily).cast(f"array<struct<{_fields(record)}>>").alias("data"))


def weather_days(days: DataFrame, city: Column) -> DataFrame:
    """Days as rows of the raw weather table."""
    return days.select(
        F.to_date("time").alias("date"), city.alias("city"), "temp_max_f", "temp_min_f",
        "precipitation_inches", "wind_speed_max_mph", "weather_code",
    )


def weather_page(spark: SparkSession, path: str, city: str) -> DataFrame:
    """A page of parallel arrays, one element per day, as rows of the raw weather table."""
    page = spark.read.option("multiLine", True).schema(schemas.DAILY_WEATHER_PAGE).json(path)
    return weather_days(page.select(F.inline(_day_columns(F.col("daily")))), F.lit(city))


# Records to raw tables.
def hourly_demand(records: DataFrame) -> DataFrame:
    """Timestamp and demand of each hour; text that is no number becomes NULL."""
    stamp = F.coalesce(
        F.try_to_timestamp("period", F.lit("yyyy-MM-dd'T'HH")), F.try_to_timestamp("period")
    )
    return records.select(stamp.cast("timestamp_ntz").alias("ts"), to_number("value").alias("demand_mwh"))


def generator_inventory(records: DataFrame, state: str = "CO") -> DataFrame:
    """Generators with fuel names and numeric capacities. Column names are looked up, since they vary by endpoint."""
    names = records.columns
    plant, generator = first_containing(names, ["plantname", "plant_name"]), first_containing(names, ["generatorid", "generator_id"])
    numbers = present_columns(records, ["net-summer-capacity-mw", "nameplate-capacity-mw", "latitude", "longitude"])
    number = lambda name: to_number(F.col(f"`{name}`")) if name in numbers else F.lit(None).cast("double")
    code = F.col("energy_source_code") if "energy_source_code" in names else F.lit("")
    return records.select(
        period_to_month("period").alias("period"),
        F.lit(state).alias("state"),
        first_present_col(names, [plant] if plant else []).alias("plant_name"),
        first_present_col(names, [generator] if generator else []).alias("generator_id"),
        F.coalesce(code, F.lit("")).alias("energy_source_code"),
        F.coalesce(fuel_type(code), F.lit("")).alias("fuel_type"),
        first_present_col(names, ["technology"]).alias("technology"),
        number("net-summer-capacity-mw").alias("net_summer_capacity_mw"),
        number("nameplate-capacity-mw").alias("nameplate_capacity_mw"),
        number("latitude").alias("latitude"),
        number("longitude").alias("longitude"),
    )


def retail_sales(records: DataFrame, state_id: str = "CO", state_name: str = "Colorado") -> DataFrame:
    """One row per month, sector and metric that the endpoint returned."""
    names = records.columns
    if not {"sectorid", "sector", "sectorName", "typeName"} & set(names):
        raise ValueError("the records have no column that names a sector")
    ids = [
        first_filled_col(names, ["period"]).alias("period"),
        first_filled_col(names, ["stateid"], state_id).alias("state_id"),
        first_filled_col(names, ["stateName", "stateDescription"], state_name).alias("state_name"),
        first_filled_col(names, ["sectorid", "sector"]).alias("sector"),
        first_filled_col(names, ["sectorName", "typeName"]).alias("sector_name"),
    ]
    return melt_with_units(records, ids, rules.SALES_METRICS)
