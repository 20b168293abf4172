"""Build every mart from raw tables and write it. Plain function calls in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import Audit, ColumnTest
from ..sources import readers, writers
from . import marts, staging, summaries


def build(
    spark: SparkSession, raw_folder: str, mart_folder: str, tests: Mapping[str, Sequence[ColumnTest]]
) -> tuple[list[str], list[DataFrame]]:
    """Read ``raw_*`` tables and write a version of every mart that is not published yet: their paths, and reports of ``tests``.

    Detail marts are partitioned by year and month. Marts that others read are read from the new versions, so each raw
    table is scanned once. Row-wise tests are counted while a mart is written.
    """
    raw = lambda name: readers.table(spark, raw_folder, name)
    paths, reports = [], []

    def put(name: str, df: DataFrame, by: tuple = ()) -> DataFrame:
        audit = Audit(df, name, tests.get(name, ()))
        paths.append(writers.write_version(audit.frame, mart_folder, name, by))
        written = spark.read.parquet(paths[-1])
        if audit.tests:
            reports.append(audit.report(written))
        return written

    days = staging.weather_days(raw("raw_weather"))
    monthly = ("year", "month_num")
    weather = put("mart_weather_operations", marts.weather_operations(days))
    outages = put("mart_outages_operations", marts.outages_operations(staging.outages(raw("raw_outages")), days), monthly)
    safety = put("mart_safety_operations", marts.safety_operations(staging.safety(raw("raw_safety")), days), monthly)
    workforce = put("mart_workforce_operations", marts.workforce_operations(staging.workforce(raw("raw_workforce")), days), monthly)
    put("mart_om_spend", marts.om_spend_mart(staging.om_spend(raw("raw_om_spend"))))
    put("mart_eia_weather", writers.stamped(marts.demand_weather(staging.demand(raw("raw_eia_demand")), days)))
    put("mart_generator_mix", writers.stamped(marts.generator_mix(staging.generators(raw("raw_eia_generators")))))
    put("mart_eia_sales_by_sector", writers.stamped(marts.sales_by_sector(staging.retail_sales(raw("raw_eia_supply_disposition")))))
    grid = put("mart_grid_operations", marts.by_centrality(marts.grid_operations(staging.grid_nodes(raw("raw_grid_nodes")), raw("raw_grid_edges"))))
    daily = put("mart_operations_summary", marts.operations_summary(weather, outages, workforce, safety))
    ranked = summaries.ranked_cities(daily)
    put("raw_spark_city_summary", writers.stamped(writers.city_summary_export(ranked)))
    put("city_grid_summary", summaries.cities_with_grid(ranked, summaries.grid_by_city(grid)))
    return paths, reports


def publish(spark: SparkSession, paths: Sequence[str]) -> None:
    """Publish written versions, and remove versions that were replaced long ago."""
    for path in paths:
        writers.publish(spark, path)
    for path in paths:
        folder, name = path.rsplit("/", 1)[0].removesuffix(writers.VERSIONS).rsplit("/", 1)
        writers.remove_old_versions(spark, folder, name)


def refresh(spark: SparkSession, raw_folder: str, mart_folder: str) -> list[str]:
    """Write all marts and publish them untested; their paths. ``ingest.refresh_checked`` publishes only what passes."""
    paths, _ = build(spark, raw_folder, mart_folder, {})
    publish(spark, paths)
    return paths


STAGING_MODELS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_weather": ("raw_weather", staging.weather_days),
    "stg_eia_demand": ("raw_eia_demand", staging.demand),
    "stg_eia_generators": ("raw_eia_generators", staging.generators),
    "stg_eia_supply_disposition": ("raw_eia_supply_disposition", staging.retail_sales),
    "stg_grid": ("raw_grid_nodes", staging.grid_nodes),
    "stg_om_spend": ("raw_om_spend", staging.om_spend),
    "stg_outages": ("raw_outages", staging.outages),
    "stg_safety": ("raw_safety", staging.safety),
    "stg_workforce": ("raw_workforce", staging.workforce),
}


def staging_views(spark: SparkSession, raw_folder: str) -> None:
    """Register every staging model as a temporary view, for SQL users."""
    for view, (source, model) in STAGING_MODELS.items():
        writers.replace_view(model(readers.table(spark, raw_folder, source)), view)
