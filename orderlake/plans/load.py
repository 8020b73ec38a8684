"""Silver -> raw orders: the load job with its ledgers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.operators.checks import (
    LOADED_FILE_CONSTRAINTS,
    RAW_CONSTRAINTS,
    WATERMARK_CONSTRAINTS,
    assert_constraints,
)
from orderlake.operators.delivery import current_state, first_deliveries, insert_absent, to_warehouse_row
from orderlake.operators.key_repair import apply_overlay
from orderlake.operators.windows import LoadWindow, Partition, list_files, select_files
from orderlake.plans.repairs import applied_repairs
from orderlake.session import stage, unstage
from orderlake.sources.tables import Paths, raw_orders, read_silver, read_table, with_metadata_position, write_run
from orderlake.sources.versions import Snapshot, VersionedTable

# Up to this many chosen files are named in the scan, so the others are not opened; more are joined as a table.
NAMED_FILES = 2_000


@dataclass(frozen=True)
class LoadCounters:
    files_discovered: int
    files_skipped: int
    files_loaded: int
    rows_processed: int
    rows_inserted: int

    @property
    def duplicates(self) -> int:
        return self.rows_processed - self.rows_inserted

    def as_run_columns(self) -> dict[str, int]:
        columns = {f"loader_{name}": value for name, value in asdict(self).items()}
        return {**columns, "loader_duplicates": self.duplicates}


def current_watermark(spark: SparkSession, paths: Paths) -> Partition | None:
    ledger = read_table(spark, paths.ledger("loader_watermarks"), S.WATERMARKS, "load_id")
    # Watermarks only move by runs; the later run wins.
    row = current_state(ledger, "dataset_name", "updated_at").where(F.col("dataset_name") == S.DATASET).first()
    return None if row is None else (row.watermark_date, row.watermark_hour)


def count_load(files: DataFrame) -> DataFrame:
    """File-side counters of a load from its marked file list."""
    return files.agg(
        F.count("*").alias("files_discovered"),
        F.count_if(~F.col("selected")).alias("files_skipped"),
        F.count_if("selected").alias("files_loaded"),
        F.coalesce(F.sum(F.when(F.col("selected"), F.col("row_count"))), F.lit(0)).alias("rows_processed"),
        F.max(F.struct("ingestion_date", "ingestion_hour")).alias("last_partition"),
    )


def rows_of_files(silver: DataFrame, chosen: DataFrame, n_chosen: int) -> DataFrame:
    """Rows of the chosen files, opening as few other files as possible."""
    if n_chosen <= NAMED_FILES:
        names = [row.file_path for row in chosen.select("file_path").collect()]  # at most NAMED_FILES
        return silver.where(F.col("file_path").isin(names))
    return silver.join(chosen.select("file_path"), "file_path", "left_semi")


def absent_events(raw: VersionedTable, loaded: Snapshot, names: Iterable[str], batch: DataFrame) -> DataFrame:
    """Rows of a staged ``batch`` whose event is in none of the named parts; only the batch's buckets are opened."""
    return insert_absent(raw.read(loaded, names, raw.buckets_of(batch)), batch)


def run_load(
    spark: SparkSession,
    paths: Paths,
    window: LoadWindow,
    load_id: str,
    loaded_at: datetime,
) -> LoadCounters:
    """Load one window. All rows get one ``loaded_at`` and become the part ``load_id`` of a new version of raw.

    A run that failed half way is run again under its ``load_id`` and replaces what it
    wrote; its own earlier attempt counts neither as loaded nor as present.
    """
    try:
        return _load(spark, paths, window, load_id, loaded_at)
    finally:
        unstage(spark, f"files-{load_id}", f"batch-{load_id}")


def _load(spark: SparkSession, paths: Paths, window: LoadWindow, load_id: str, loaded_at: datetime) -> LoadCounters:
    silver = with_metadata_position(read_silver(spark, paths)).where(window.predicate())
    ledger = read_table(spark, paths.ledger("loaded_files"), S.LOADED_FILES, "load_id").where(F.col("load_id") != load_id)
    files = stage(select_files(list_files(silver), window, ledger), f"files-{load_id}")
    found = count_load(files).first()
    if found.files_discovered == 0:
        return LoadCounters(0, 0, 0, 0, 0)

    inserted = 0
    raw = raw_orders(spark, paths)
    loaded = raw.current()
    part = None
    if found.files_loaded:
        rows = rows_of_files(silver, files.where("selected"), found.files_loaded)
        # Repairs change no delivery order, so they wait until one row per event is left.
        first = apply_overlay(first_deliveries(rows), applied_repairs(spark, paths))
        batch = stage(to_warehouse_row(first), f"batch-{load_id}")
        # Uniqueness holds by construction and is tested on the changed buckets by the models' tests.
        by_row = [check for check in RAW_CONSTRAINTS if check.kind != "unique"]
        assert_constraints(batch.withColumn("loaded_at", F.lit(loaded_at)), "raw_orders", by_row)
        new = absent_events(raw, loaded, [n for n in loaded.parts if n != load_id], batch)
        part = raw.write(new.withColumn("loaded_at", F.lit(loaded_at)), load_id)
        inserted = raw.read_folders({part.folder} - {""}).count()  # by the footers
    if inserted or load_id in loaded.parts:
        raw.commit(loaded, {load_id: part if inserted else None})

    entries = files.where("selected AND NOT loaded_before").select(
        "file_path",
        F.lit(S.DATASET).alias("dataset_name"),
        "ingestion_date",
        "ingestion_hour",
        "row_count",
        F.lit(loaded_at).alias("loaded_at"),
    )
    assert_constraints(entries, "loaded_files", LOADED_FILE_CONSTRAINTS)
    write_run(entries, paths.ledger("loaded_files"), "load_id", load_id)
    if window.advances_watermark:
        last = found.last_partition
        mark = spark.createDataFrame(
            [(S.DATASET, last.ingestion_date, last.ingestion_hour, loaded_at)], S.WATERMARKS
        )
        assert_constraints(mark, "loader_watermarks", WATERMARK_CONSTRAINTS)
        write_run(mark, paths.ledger("loader_watermarks"), "load_id", load_id)
    return LoadCounters(
        found.files_discovered, found.files_skipped, found.files_loaded, found.rows_processed, inserted
    )
