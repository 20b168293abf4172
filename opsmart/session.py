"""Session helpers: settings for local runs and safe lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: int | str = "*", name: str = "opsmart", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster use the session it provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("OPSMART_DRIVER_MEMORY", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing setting is an error, because other machines could not read it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="opsmart-checkpoint-")
    context.setCheckpointDir(folder)


def scratch_path(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/opsmart-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write the frame once as a table in the checkpoint folder and continue from the table.

    Used where a small or iterated result is read several times: later steps
    neither repeat the work nor depend on executors that may be lost. A table
    rather than an RDD checkpoint, because its size is known to the join
    planning that follows and an iterated plan starts afresh in every round.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, **values: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and the row count (``rows``) and other aggregates taken while the table is written."""
    from pyspark.sql import functions as F

    seen = Observation()
    table = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in values.items())))
    return table, seen.get


def materialize_bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """``materialize`` in buckets of the keys, as many as shuffle partitions.

    Aggregations by these keys, and joins of such aggregates, then need no further exchange. For facts that several
    results are derived from. The table has a name in the session's catalog, since only those can have buckets.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def discard(df: DataFrame) -> None:
    """Remove a table made by ``materialize`` that a later round has replaced, so that rounds do not pile up."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if not folder.rsplit("/", 1)[1].startswith("opsmart-"):
            raise ValueError(f"{folder} is no intermediate table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
