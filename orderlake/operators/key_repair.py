"""Guarded repair of wrong order ids in Silver.

Sink files are never rewritten: a changed file no longer matches its checksum and
the sink's commit log. A repair is a new set of rows laid over the old ones.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Outcomes of a requested repair.
NO_MATCH, UNEXPECTED_ORDER_ID, READY = "NO_MATCH", "UNEXPECTED_ORDER_ID", "READY"


class KeyRepair(NamedTuple):
    report: DataFrame
    files: DataFrame
    rows: DataFrame


def match_files(silver: DataFrame, key_map: DataFrame) -> DataFrame:
    """Copies per event and file, and the lowest and highest order id among them.

    Silver is cut down to the named events first (a map that Spark knows to be small is broadcast for it), and combined
    in the tasks: an event of very many copies stays small.
    """
    named = silver.select("event_id", "file_path", "order_id").join(key_map.select("event_id"), "event_id", "left_semi")
    combined = named.groupBy("event_id", "file_path", "order_id").agg(F.count("*").alias("n"))
    expected = F.col("order_id").eqNullSafe(F.col("old_order_id"))
    return combined.join(key_map, "event_id").groupBy("event_id", "file_path").agg(
        F.sum("n").alias("copies"),
        F.min("order_id").alias("lowest_order_id"),
        F.max("order_id").alias("highest_order_id"),
        F.sum(F.when(expected, F.lit(0)).otherwise(F.col("n"))).alias("unexpected_copies"),
    )


def repair_report(files: DataFrame, key_map: DataFrame) -> DataFrame:
    """Per event: refused without copies, or if any copy has another id than expected."""
    per_event = files.groupBy("event_id").agg(
        F.sum("copies").alias("copies"),
        F.count("*").alias("files"),
        F.sum("unexpected_copies").alias("unexpected_copies"),
    )
    counted = key_map.join(per_event, "event_id", "left").select(
        *key_map.columns,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("copies", "files", "unexpected_copies")],
    )
    outcome = (
        F.when(F.col("copies") == 0, NO_MATCH)
        .when(F.col("unexpected_copies") > 0, UNEXPECTED_ORDER_ID)
        .otherwise(READY)
    )
    return counted.withColumn("outcome", outcome)


def apply_overlay(silver: DataFrame, repairs: DataFrame) -> DataFrame:
    """Silver as read with the ready repairs applied."""
    changes = repairs.where(F.col("outcome") == READY).select("event_id", "new_order_id")
    repaired = silver.join(changes, "event_id", "left")
    columns = [
        F.coalesce("new_order_id", "order_id").alias("order_id") if c == "order_id" else c for c in silver.columns
    ]
    return repaired.select(*columns)


def repair_order_ids(silver: DataFrame, key_map: DataFrame) -> KeyRepair:
    """Dry run: the verdict per event, the matches per file, and the rows as they would become.

    ``silver`` carries ``file_path``; ``key_map`` has one row per event
    (``schemas.ORDER_KEY_MAP``).
    """
    files = match_files(silver, key_map)
    report = repair_report(files, key_map)
    ready = report.where(F.col("outcome") == READY).select("event_id", "new_order_id")
    matching = silver.join(ready, "event_id", "inner")
    columns = [F.col("new_order_id").alias("order_id") if c == "order_id" else c for c in silver.columns]
    return KeyRepair(report, files, matching.select(*columns))


def verify_rewrite(report: DataFrame, rewritten: DataFrame) -> DataFrame:
    """Events whose rewritten rows differ in number or id from what the report promised."""
    written = rewritten.groupBy("event_id").agg(
        F.count("*").alias("_written"), F.min("order_id").alias("_low"), F.max("order_id").alias("_high")
    )
    promised = report.where(F.col("outcome") == READY).join(written, "event_id", "left")
    right = (
        (F.col("_written") == F.col("copies"))
        & (F.col("_low") == F.col("new_order_id"))
        & (F.col("_high") == F.col("new_order_id"))
    )
    return promised.where(~F.coalesce(right, F.lit(False))).select("event_id", "copies", "_written")
