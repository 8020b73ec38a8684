"""Lake layers, ledgers and warehouse tables as Parquet folders.

Nothing is updated in place. To a ledger each job writes a partition named after itself
and a retry overwrites that partition; the warehouse tables have versions
(``sources.versions``). So a job that lost its executors can run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake import schemas as S
from orderlake.sources import files
from orderlake.sources.versions import VersionedTable, part_folder


@dataclass(frozen=True)
class Paths:
    """Folder layout under one root."""

    root: str

    def lake(self, layer: str) -> str:
        return f"{self.root}/lake/{layer}/orders"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/lake/checkpoints/{query}"

    def lake_commits(self) -> str:
        return f"{self.root}/lake/commits"

    def judged_batch(self) -> str:
        """The messages of the batch that the single-pass stream is at."""
        return f"{self.root}/lake/judged_batch"

    def table(self, name: str) -> str:
        return f"{self.root}/warehouse/{name}"

    def ledger(self, name: str) -> str:
        return f"{self.root}/control/{name}"


def read_table(spark: SparkSession, path: str, schema: T.StructType, *partitions: str) -> DataFrame:
    """A table folder, empty if nothing was written yet.

    Always read at the root: there Spark takes exactly the files the streaming sink
    committed, while a glob or a partition folder would also pick up strays.
    ``schema`` lets older files lack newer columns (read as NULL).
    """
    extra = T.StructType([T.StructField(p, T.StringType()) for p in partitions])
    full = T.StructType(schema.fields + extra.fields)
    if not files.exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def last_commit(spark: SparkSession, paths: Paths) -> int | None:
    """The newest batch that the single-pass stream has written to all layers; batches are committed in order."""
    names = [name for name, _ in files.list_names(spark, paths.lake_commits()) if name.isdigit()]
    return max(map(int, names), default=None)


def _read_layer(spark: SparkSession, paths: Paths, layer: str, schema: T.StructType) -> DataFrame:
    if not files.exists(spark, paths.lake_commits()):
        return read_table(spark, paths.lake(layer), schema).select(*schema.fieldNames())
    # The single-pass stream adds a folder level; of its batches only whole ones count.
    batched = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    last = last_commit(spark, paths)
    rows = read_table(spark, paths.lake(layer), batched).where(F.col("batch_id") <= (-1 if last is None else last))
    return rows.select(*schema.fieldNames())


def read_bronze(spark: SparkSession, paths: Paths) -> DataFrame:
    return _read_layer(spark, paths, "bronze", S.BRONZE)


def read_arrivals(spark: SparkSession, paths: Paths) -> DataFrame:
    """Bronze with the id of the repair that sent a message."""
    repair = T.StructType([*S.BRONZE.fields, T.StructField("reprocessing_id", T.StringType())])
    return _read_layer(spark, paths, "bronze", repair)


def read_silver(spark: SparkSession, paths: Paths) -> DataFrame:
    return _read_layer(spark, paths, "silver", S.SILVER)


def read_quarantine(spark: SparkSession, paths: Paths) -> DataFrame:
    return _read_layer(spark, paths, "quarantine", S.QUARANTINE)


def with_metadata_position(silver: DataFrame) -> DataFrame:
    """Silver rows with the file they sit in and their place in it."""
    try:
        return silver.select(
            "*",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.row_index").alias("row_index"),
        )
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        # Nothing was written yet, so the frame is empty and comes from no file.
        return silver.selectExpr("*", "cast(NULL AS string) AS file_path", "cast(NULL AS bigint) AS row_index")


def write_run(df: DataFrame, path: str, partition: str, value: str) -> None:
    """Replace one job's partition of a table, leaving the others alone.

    The partition's own folder is overwritten, so a retry that has no rows empties it too.
    """
    rows = df.drop(partition)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{part_folder(partition, value)}")


def raw_orders(spark: SparkSession, paths: Paths) -> VersionedTable:
    """One part per load, in buckets of the event id."""
    return VersionedTable(spark, paths.table("raw_orders"), S.RAW_ORDERS, "load_id", bucket_by="event_id")


def fct_orders(spark: SparkSession, paths: Paths) -> VersionedTable:
    """One part per build, in buckets of the event id; made from folders of raw orders."""
    return VersionedTable(spark, paths.table("fct_orders"), S.FACT_ORDERS, "build_id", bucket_by="event_id")


def daily_totals(spark: SparkSession, paths: Paths) -> VersionedTable:
    """The sums behind the daily mart, one part per business month; made from folders of the fact."""
    return VersionedTable(spark, paths.table("mart_daily_sales"), S.DAILY_TOTALS, "month")
