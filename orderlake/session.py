"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from orderlake.sources import files

# Dates and hours of the lake are UTC dates and hours, whatever the machine says.
UTC_CONF = ("spark.sql.session.timeZone", "UTC")

DEFAULT_CONF = {
    UTC_CONF[0]: UTC_CONF[1],
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A committed file that vanished is an error, never a smaller count.
    "spark.sql.files.ignoreMissingFiles": "false",
    # Recording the call site of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "orderlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Use UTC on a session somebody else built."""
    spark.conf.set(*UTC_CONF)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster an
    executor could not read what another one wrote there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="orderlake-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage with a table that survives lost executors, so that counting
    a batch and writing it later do not compute it twice.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/staged/{name}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, *names: str) -> None:
    """Remove staged tables that nothing reads any more."""
    for name in names:
        files.remove(spark, f"{scratch_root(spark)}/staged/{name}")


def held(df: DataFrame) -> DataFrame:
    """A frame of a few rows, computed once and kept by the driver: verdicts and the like, never data."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
