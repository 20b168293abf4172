"""Writers. Every task writes its own files; a table is replaced as a whole, by a version that readers see when it is complete."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Versions of a table lie in the folder ``<name>.versions``; a version counts once its commit record lies beside it.
VERSIONS, COMMITTED = ".versions", ".committed"
#: Hours for which a replaced version stays readable for those who opened it before.
KEEP_HOURS = 48.0


def stamped(df: DataFrame) -> DataFrame:
    """Audit column with one value for the whole query."""
    return df.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))


def _writer(df: DataFrame, partition_by: Sequence[str]):
    """Rows of one table partition meet in few tasks, and a very large one is split again by adaptive execution."""
    if not partition_by:
        return df.write
    return df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _committed(spark: SparkSession, folder: str, name: str) -> list[tuple[str, int]]:
    """Committed versions of a table, oldest first, and when each was committed."""
    files, place = _files(spark, f"{folder.rstrip('/')}/{name}{VERSIONS}")
    if not files.exists(place):
        return []
    found = [(f.getPath().getName(), f.getModificationTime()) for f in files.listStatus(place)]
    return sorted((n.removesuffix(COMMITTED), at) for n, at in found if n.endswith(COMMITTED))


def current_version(spark: SparkSession, folder: str, name: str) -> str | None:
    """Path of the newest committed version of a table; None where it has none."""
    found = _committed(spark, folder, name)
    return f"{folder.rstrip('/')}/{name}{VERSIONS}/{found[-1][0]}" if found else None


def write_version(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version of a table that nobody reads yet; its path. Partition columns let later reads skip files."""
    found = _committed(df.sparkSession, folder, name)
    number = int(found[-1][0].split("-")[0]) + 1 if found else 1
    path = f"{folder.rstrip('/')}/{name}{VERSIONS}/{number:010d}-{uuid.uuid4().hex}"
    _writer(df, partition_by).parquet(path)
    return path


def publish(spark: SparkSession, path: str) -> None:
    """Make a version written by ``write_version`` the one that readers find: one small file is created.

    Nothing is renamed or deleted, so there is no moment without a table, and who reads an older version goes on.
    """
    files, place = _files(spark, f"{path}{COMMITTED}")
    if not files.createNewFile(place):
        raise ValueError(f"{path} is published already")


def remove_old_versions(spark: SparkSession, folder: str, name: str, hours: float = KEEP_HOURS) -> list[str]:
    """Remove versions that were replaced at least so many hours ago, and versions of that age that were never published.

    Times are those of the file system, compared with this machine's clock. The newest version always stays.
    """
    base = f"{folder.rstrip('/')}/{name}{VERSIONS}"
    files, place = _files(spark, base)
    found, limit = _committed(spark, folder, name), (time.time() - hours * 3600) * 1000
    old = [n for (n, _), (_, replaced) in zip(found, found[1:]) if replaced <= limit]
    known = {n for n, _ in found}
    if files.exists(place):
        tries = [f for f in files.listStatus(place) if f.isDirectory() and f.getPath().getName() not in known]
        old += [f.getPath().getName() for f in tries if f.getModificationTime() <= limit]
    for version in old:
        # The record goes first: a version without one is never read, whatever happens to its files.
        for each, deep in ((f"{base}/{version}{COMMITTED}", False), (f"{base}/{version}", True)):
            files.delete(_files(spark, each)[1], deep)
    return old


def replace_files(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = (), keep_hours: float = KEEP_HOURS) -> str:
    """Replace a Parquet table below a folder; the path of the new version. An interrupted write changes nothing.

    Read it with ``readers.table``, which finds the newest version once and then stays with its files.
    """
    path = write_version(df, folder, name, partition_by)
    publish(df.sparkSession, path)
    remove_old_versions(df.sparkSession, folder, name, keep_hours)
    return path


def replace_table(df: DataFrame, name: str, folder: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table of the session catalog, whose versions lie below ``folder``.

    The name stands for the files of one version, so replacing it is one change in the catalog, whatever its columns: it
    is never missing, and queries that have begun go on with the files they know.
    """
    path = replace_files(df, folder, name.rsplit(".", 1)[-1], partition_by)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def city_summary_export(ranked: DataFrame) -> DataFrame:
    """The published columns of the ranked city summary, typed for export."""
    double = lambda source, name=None: F.col(source).cast("double").alias(name or source)
    return ranked.select(
        "city_name",
        F.col("stress_rank").cast("int").alias("stress_rank"),
        "risk_label",
        double("avg_stress_score"),
        double("avg_daily_outages"),
        double("total_outages"),
        double("total_customer_minutes_lost", "total_customer_min_lost"),
        double("avg_crews_per_day"),
        double("total_labor_cost"),
        double("avg_temperature_f"),
        double("avg_heating_degree_days"),
        double("avg_cooling_degree_days"),
    )
