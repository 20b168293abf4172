"""From landed API pages to raw tables, finished marts and their column tests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import betweenness, quality
from ..operators.filters import first_non_empty
from ..session import materialize
from ..sources import readers, writers
from . import contracts, refresh, staging

MANIFEST = "page string, request string, modified timestamp, length bigint, digest string, total bigint, origin string"
QUARANTINE = "page string, digest string, _corrupt_record string"


@dataclass(frozen=True)
class Source:
    """Pages below ``folder`` of the landing area with records of one type, made into one raw table.

    ``key`` names the columns that tell the records of a request apart. Where the folder has no record at all, the
    records below ``fallback`` are used. ``page`` finds the total and the records in the text of a page.
    """

    folder: str
    record: str
    key: tuple[str, ...]
    table: str
    build: Callable[[DataFrame], DataFrame]
    fallback: str | None = None
    page: Callable[[str, str], Column] = readers.api_page
    announced: bool = True  # pages name the number of their request's records


def _demand(records: DataFrame) -> DataFrame:
    return staging.daily_demand(readers.hourly_demand(records))


def _weather(days: DataFrame) -> DataFrame:
    """The folder of a city's pages has its name."""
    return readers.weather_days(days, F.substring_index("request", "/", -1))


SOURCES = (
    Source("demand", schemas.DEMAND_RECORD, ("period",), "raw_eia_demand", _demand),
    Source(
        "generators", schemas.GENERATOR_RECORD, ("period", "stateid", "plantName", "generatorid", "energy_source_code"),
        "raw_eia_generators", readers.generator_inventory,
    ),
    Source(
        "sales", schemas.SALES_RECORD, ("period", "stateid", "sectorid", "sector"), "raw_eia_supply_disposition",
        readers.retail_sales, fallback="sales_fallback",
    ),
    Source("weather", schemas.DAILY_WEATHER, ("time",), "raw_weather", _weather, page=readers.daily_page, announced=False),
)


def _state(raw_folder: str, source: Source, name: str) -> str:
    return f"{raw_folder.rstrip('/')}/_taken/{source.table}/{name}"


def _kept(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What earlier runs appended to a table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _records_schema(source: Source) -> str:
    return f"page string, request string, modified timestamp, digest string, origin string, {source.record}"


def take_pages(spark: SparkSession, landed: str, raw_folder: str, source: Source) -> int:
    """Take the pages that no earlier run has taken, by path, time and length: how many.

    Their records and the texts of bad pages are appended first and the manifest last. A run that fails in between takes
    the pages again, and ``current_records`` counts each record once. The driver holds the paths of new pages, as Spark
    does for every read.
    """
    taken = _kept(spark, _state(raw_folder, source, "pages"), MANIFEST).select("page", "modified", "length")
    new = []
    for folder in filter(None, (source.folder, source.fallback)):
        files = readers.page_files(spark, f"{landed.rstrip('/')}/{folder}")
        paths = [r["page"] for r in files.join(taken, ["page", "modified", "length"], "left_anti").select("page").collect()]
        if paths:
            texts = readers.page_texts(spark, paths).withColumn("p", source.page("text", source.record))
            new.append(texts.withColumn("origin", F.lit(folder)))
    if not new:
        return 0
    pages = materialize(reduce(DataFrame.unionByName, new))
    named = ("page", "request", "modified", "digest", "origin")
    records = pages.select(*named, F.explode("p.data").alias("r")).select(*named, "r.*")
    records.write.mode("append").parquet(_state(raw_folder, source, "records"))
    bad = pages.filter(F.col("p.data").isNull()).select("page", "digest", F.col("text").alias("_corrupt_record"))
    bad.write.mode("append").parquet(_state(raw_folder, source, "quarantine"))
    manifest = pages.select("page", "request", "modified", "length", "digest", F.col("p.total").alias("total"), "origin")
    manifest.write.mode("append").parquet(_state(raw_folder, source, "pages"))
    return pages.count()


def _current_pages(spark: SparkSession, raw_folder: str, source: Source) -> DataFrame:
    """One row per page: as it was landed last."""
    pages = _kept(spark, _state(raw_folder, source, "pages"), MANIFEST)
    last = F.max_by(F.struct("request", "digest", "total", "origin"), F.struct("modified", "digest"))
    return pages.groupBy("page").agg(last.alias("p")).select("page", "p.*")


def current_records(spark: SparkSession, raw_folder: str, source: Source) -> DataFrame:
    """Every taken record once: (origin, request, the record's columns).

    Records of one request with equal keys are one record, as it stands on the page landed last; without any key
    column the whole record is its key. Records of a page that was landed anew with other content are gone with it.
    """
    pages = _current_pages(spark, raw_folder, source).select("page", "digest")
    records = _kept(spark, _state(raw_folder, source, "records"), _records_schema(source)).join(pages, ["page", "digest"], "left_semi")
    names = [c for c in records.columns if c not in ("page", "modified", "digest", "origin", "request")]
    whole = F.struct(*(F.col(f"`{c}`") for c in names))
    key = F.when(F.coalesce(*(F.col(f"`{c}`").cast("string") for c in source.key)).isNotNull(), F.to_json(F.struct(*(F.col(f"`{c}`") for c in source.key))))
    last = F.max_by(whole, F.struct("modified", "page", F.to_json(whole)))
    once = records.groupBy("origin", "request", F.coalesce(key, F.to_json(whole)).alias("__key")).agg(last.alias("r"))
    return once.select("origin", "request", "r.*")


def _completeness(pages: DataFrame, records: DataFrame, announced: bool) -> DataFrame:
    """Records of each request against the total that it announces, one row, for the requests that the table is made of.

    Where requests announce nothing, a request with records is complete.
    """
    used = records.select("origin").distinct()
    requests = pages.join(used, "origin", "left_semi").groupBy("request").agg(F.max("total").alias("announced"))
    found = records.groupBy("request").agg(F.count("*").alias("found"))
    each = requests.join(found, "request", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    same = F.coalesce(F.col("found") == F.col("announced"), F.lit(False)) if announced else F.col("found") > 0
    return each.agg(
        F.coalesce(F.sum("found"), F.lit(0)).alias("fetched"), F.sum("announced").alias("announced"),
        F.coalesce(F.bool_and(same), F.lit(False)).alias("complete"),
    )


def ingest(
    spark: SparkSession, landed: str, raw_folder: str, sources: tuple[Source, ...] = SOURCES, publish_incomplete: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Take new pages of every source and publish its stamped raw table; (completeness per table, bad pages).

    A run may be repeated at any time: a page is taken once, a record is in its table once however often it was
    landed, and a late page completes what earlier runs began. A table with fewer or more records than its requests
    announce is not published, so its last complete version stays, unless ``publish_incomplete``. A source without any
    page is left out.
    """
    complete, bad = [], []
    for source in sources:
        take_pages(spark, landed, raw_folder, source)
        pages = materialize(_current_pages(spark, raw_folder, source))
        if pages.isEmpty():
            continue
        records = current_records(spark, raw_folder, source)
        first = records.filter(F.col("origin") == source.folder)
        second = records.filter(F.col("origin") == F.lit(source.fallback))
        chosen = materialize(first_non_empty(first, second) if source.fallback else first)
        state = materialize(_completeness(pages, chosen, source.announced))
        if publish_incomplete or state.first()["complete"]:
            writers.replace_files(writers.stamped(source.build(chosen.drop("origin"))), raw_folder, source.table)
        name = F.lit(source.table).alias("table_name")
        complete.append(state.select(name, "*"))
        quarantine = _kept(spark, _state(raw_folder, source, "quarantine"), QUARANTINE).distinct()
        bad.append(quarantine.join(pages.select("page", "digest"), ["page", "digest"], "left_semi").select(name, "page", "_corrupt_record"))
    if not complete:
        raise ValueError(f"no page of {', '.join(s.folder for s in sources)} below {landed}")
    return reduce(DataFrame.unionByName, complete), reduce(DataFrame.unionByName, bad)


def build_network(nodes: DataFrame, edges: DataFrame, raw_folder: str) -> None:
    """Write the raw network tables: nodes (``node_id``) with both centralities, and lines."""
    ends = edges.select(F.col("source_node").alias("src"), F.col("target_node").alias("dst"), F.col("distance_miles").alias("weight"))
    scores = betweenness.scored_nodes(nodes.select(F.col("node_id").alias("node")), ends)
    scored = nodes.join(scores, F.col("node_id") == F.col("node"), "left").drop("node")
    writers.replace_files(writers.stamped(scored), raw_folder, "raw_grid_nodes")
    writers.replace_files(writers.stamped(edges), raw_folder, "raw_grid_edges")


def refresh_checked(spark: SparkSession, raw_folder: str, mart_folder: str) -> DataFrame:
    """Write all marts, test what was written, then publish it; the report of the tests.

    If an ``error`` test fails, nothing is published: all marts stay as they were, and the error names the tests.
    Warnings do not stop.
    """
    paths, reports = refresh.build(spark, raw_folder, mart_folder, contracts.MART_TESTS)
    report = materialize(reduce(DataFrame.unionByName, reports))
    failed = quality.failed_errors(report).select("table_name", "column_name", "test").collect()  # one row per test
    if failed:
        raise ValueError("failed tests: " + ", ".join(f"{r['test']} of {r['table_name']}.{r['column_name']}" for r in failed))
    refresh.publish(spark, paths)
    return report
