"""Run ledger, metrics history and what operators look at."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.functions.scalars import freshness_minutes

STARTED, UPDATED = "STARTED", "UPDATED"


def run_event(spark: SparkSession, run_id: str, at: datetime, started: bool = False, **columns: Any) -> DataFrame:
    """One entry of the run ledger: a (re)start, or new values of some run columns."""
    unknown = set(columns) - set(S.RUN_COLUMNS.fieldNames())
    if unknown:
        raise ValueError(f"not run columns: {sorted(unknown)}")
    if started:
        columns = {"status": "RUNNING", **columns}
    row = {"run_id": run_id, "event": STARTED if started else UPDATED, "event_at": at, **columns}
    return spark.createDataFrame([tuple(row.get(name) for name in S.RUN_EVENTS.fieldNames())], S.RUN_EVENTS)


def current_runs(ledger: DataFrame) -> DataFrame:
    """One row per run: each column's newest value since the run was last (re)started.

    One aggregation; newest values are combined in the map tasks.
    """
    started = F.col("event") == STARTED
    newest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct("event_at", (~started).alias("u"), F.col(c).alias("value")))).alias(c)
        for c in S.RUN_COLUMNS.fieldNames()
    ]
    runs = ledger.groupBy("run_id").agg(F.max(F.when(started, F.col("event_at"))).alias("started_at"), *newest)
    fresh = [
        F.when(F.col(f"{c}.event_at") >= F.col("started_at"), F.col(f"{c}.value")).alias(c)
        for c in S.RUN_COLUMNS.fieldNames()
    ]
    return runs.select("run_id", "started_at", *fresh)


def _derived_metrics() -> dict[str, Column]:
    return {
        "silver_duplicate_deliveries": F.col("silver_rows") - F.col("silver_unique_events"),
        "silver_raw_lag": F.col("silver_unique_events") - F.col("raw_orders"),
        "freshness_minutes": freshness_minutes(F.col("recorded_at"), F.col("latest_loaded_at")),
    }


def latest_metrics(metrics: DataFrame) -> DataFrame:
    newest = metrics.orderBy(F.col("recorded_at").desc(), F.col("metric_id").desc()).limit(1)
    return newest.withColumns(_derived_metrics())


def metric_history(metrics: DataFrame, n: int = 24) -> DataFrame:
    """The newest duplicate-aware snapshots, oldest first."""
    known = metrics.where(F.col("silver_unique_events").isNotNull())
    newest = known.orderBy(F.col("recorded_at").desc(), F.col("metric_id").desc()).limit(n)
    return (
        newest.withColumns(_derived_metrics())
        .select(
            "recorded_at",
            "status",
            "silver_rows",
            "silver_unique_events",
            "silver_duplicate_deliveries",
            "raw_orders",
            "silver_raw_lag",
            "freshness_minutes",
        )
        .orderBy("recorded_at")
    )


def trend_summary(history: DataFrame, *metrics: str) -> DataFrame:
    """Lowest, highest and latest value of each metric and how many snapshots have it."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value")) for m in metrics]
    values = history.select("recorded_at", F.inline(F.array(*pairs))).where("value IS NOT NULL")
    return values.groupBy("metric").agg(
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        F.max_by("value", "recorded_at").alias("latest"),
        F.count("*").alias("snapshots"),
    )


def open_incidents(incidents: DataFrame) -> DataFrame:
    """Open incidents of a current-state frame, newest first."""
    columns = ("incident_id", "incident_type", "severity", "details", "opened_at", "alert_sent_at")
    still = incidents.where(F.col("resolved_at").isNull())
    return still.select(*columns).orderBy(F.col("opened_at").desc(), "incident_id")


def recent_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    newest = runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)
    micros = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return newest.withColumn("duration_seconds", micros / F.lit(1_000_000))


def remediation_history(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.col("created_at").desc(), "reprocessing_id")
