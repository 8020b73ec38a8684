"""Counts of the lake that a check keeps up instead of counting everything again.

The distinct events of Silver are a bucketed table of keys, filled by insert-if-absent. A check reads the keys of files it
has not counted yet, opens the buckets they fall into, and adds how many of them were new to the counts by bucket; the sum
of these is exact. Keys are put in before their files are noted as counted: a check that fails between the two finds its
keys there already when it counts the files again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.operators.windows import list_files
from orderlake.plans.load import absent_events, rows_of_files
from orderlake.session import stage, unstage
from orderlake.sources.tables import Paths, read_bronze, read_quarantine, read_silver, with_metadata_position
from orderlake.sources.versions import VersionedTable

# A check adds one part; this many are put together into one.
MAX_PARTS = 64


def silver_events(spark: SparkSession, paths: Paths) -> VersionedTable:
    return VersionedTable(spark, paths.ledger("silver_events"), S.SILVER_EVENTS, "check_id", bucket_by="event_id")


def counted_files(spark: SparkSession, paths: Paths) -> VersionedTable:
    return VersionedTable(spark, paths.ledger("counted_files"), S.COUNTED_FILES, "check_id")


def refresh_silver_events(spark: SparkSession, paths: Paths, silver: DataFrame, check_id: str) -> tuple[int, int]:
    """Rows and distinct events of ``silver`` (with file positions) after taking in the files that were not counted yet."""
    keys, ledger = silver_events(spark, paths), counted_files(spark, paths)
    counted = ledger.current()
    found = list_files(silver).select("file_path", "row_count")
    new = stage(found.join(ledger.read(counted), "file_path", "left_anti"), f"counting-{check_id}")
    try:
        seen = new.agg(F.count("*").alias("files"), F.sum("row_count").alias("rows")).first()
        base = keys.current()
        by_bucket = list(base.notes.get("events", [0] * keys.buckets))
        if seen.files:
            batch = stage(rows_of_files(silver, new, seen.files).select("event_id").distinct(), f"keys-{check_id}")
            part_name = f"{check_id}-{base.number + 1}"
            part = keys.write(absent_events(keys, base, base.parts, batch), part_name)
            after = keys.read_folders({part.folder} - {""}).groupBy("bucket").agg(F.count("*").alias("n")).collect()
            for r in after:  # a row for each bucket
                by_bucket[r.bucket] += r.n
            keys.commit(base, {part_name: part}, {"events": by_bucket})
            rows = counted.notes.get("rows", 0) + seen.rows
            counted = ledger.commit(counted, {part_name: ledger.write(new, part_name)}, {"rows": rows})
            for table in (keys, ledger):
                if len(table.current().parts) > MAX_PARTS:
                    table.compact(f"{check_id}-compacted")
                    table.vacuum()
    finally:
        unstage(spark, f"counting-{check_id}", f"keys-{check_id}")
    return counted.notes.get("rows", 0), sum(by_bucket)


def maintained_lake_metrics(spark: SparkSession, paths: Paths, check_id: str) -> DataFrame:
    """What ``operators.health.lake_metrics`` gives for the stored layers, with the distinct events kept up."""
    silver = with_metadata_position(read_silver(spark, paths))
    rows, events = refresh_silver_events(spark, paths, silver, check_id)
    counts = [frame.agg(F.count("*")).first()[0] for frame in (read_bronze(spark, paths), read_quarantine(spark, paths))]
    return spark.createDataFrame(
        [(counts[0], rows, events, counts[1], rows - events)],
        "bronze_rows bigint, silver_rows bigint, silver_unique_events bigint, quarantine_rows bigint, "
        "silver_duplicate_deliveries bigint",
    )
