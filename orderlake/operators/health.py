"""Layer metrics, the health verdict, incidents and notices.

All of it works on frames: a verdict is a row of columns, so one snapshot or the
whole metrics history is judged by the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.scalars import age_minutes, as_column

# Default thresholds, incident types and the texts kept in the ledgers.
MAX_LAG_ROWS = 60
MAX_LOAD_AGE_MINUTES = 2880
BRONZE_RECONCILIATION = "BRONZE_RECONCILIATION"
SILVER_RAW_RECONCILIATION = "SILVER_RAW_RECONCILIATION"
RAW_FACT_RECONCILIATION = "RAW_FACT_RECONCILIATION"
FACT_GOLD_RECONCILIATION = "FACT_GOLD_RECONCILIATION"
WAREHOUSE_FRESHNESS = "WAREHOUSE_FRESHNESS"
BRONZE_TEXT = "Bronze does not reconcile with Silver + Quarantine: %d != %d + %d (gap=%d)"
SILVER_RAW_TEXT = "Silver unique events do not reconcile with raw.orders: %d != %d (gap=%d)"
RAW_FACT_TEXT = "raw.orders does not reconcile with fct_orders: %d != %d"
FACT_GOLD_TEXT = "fct_orders does not reconcile with Gold order count: %d != %d"
NO_LOAD_TEXT = "No warehouse load timestamp available"
STALE_TEXT = "Warehouse data is stale: %d minutes since latest load"
ALL_GOOD_TEXT = "All reconciliation and freshness checks passed"


def _one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Put one-row frames side by side (their union, one value per column)."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def lake_metrics(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows per layer and exact distinct events of Silver, each layer scanned once."""
    return _one_row(
        [
            bronze.agg(F.count("*").alias("bronze_rows")),
            silver.agg(
                F.count("*").alias("silver_rows"),
                F.count_distinct("event_id").alias("silver_unique_events"),
            ),
            quarantine.agg(F.count("*").alias("quarantine_rows")),
        ]
    ).withColumn("silver_duplicate_deliveries", F.col("silver_rows") - F.col("silver_unique_events"))


def warehouse_metrics(raw: DataFrame, fact: DataFrame, mart: DataFrame) -> DataFrame:
    return _one_row(
        [
            raw.agg(F.count("*").alias("raw_orders"), F.max("loaded_at").alias("latest_loaded_at")),
            fact.agg(F.count("*").alias("fact_orders")),
            mart.agg(F.coalesce(F.sum("order_count"), F.lit(0)).alias("gold_order_count")),
        ]
    )


def require_raw_orders(raw: DataFrame) -> tuple[int, datetime]:
    """The gate before the models: row count and latest load, an empty table is an error."""
    row = raw.agg(F.count("*").alias("row_count"), F.max("loaded_at").alias("latest_load")).first()
    if row.row_count == 0:
        raise ValueError("raw orders contain no rows")
    return row.row_count, row.latest_load


def evaluate_health(
    lake: DataFrame,
    warehouse: DataFrame | None = None,
    now: Column | datetime | None = None,
    max_lag_rows: int = MAX_LAG_ROWS,
    max_load_age_minutes: int = MAX_LOAD_AGE_MINUTES,
    strict: bool = False,
) -> DataFrame:
    """Add ``issues``, ``incident_types``, ``load_age_minutes``, ``status`` and ``details``.

    ``lake`` and ``warehouse`` are one-row metrics; or ``lake`` alone holds all
    metrics columns, one row per snapshot, with ``now`` a column of it.
    """
    if max_lag_rows < 0 or max_load_age_minutes < 0:
        raise ValueError("thresholds must be zero or greater")
    metrics = lake if warehouse is None else _one_row([lake, warehouse])
    unique = F.coalesce(F.col("silver_unique_events"), F.col("silver_rows"))
    bronze, silver, quarantine = F.col("bronze_rows"), F.col("silver_rows"), F.col("quarantine_rows")
    raw, fact, gold = F.col("raw_orders"), F.col("fact_orders"), F.col("gold_order_count")
    bronze_gap = bronze - (silver + quarantine)
    raw_gap = unique - raw
    age = age_minutes(F.current_timestamp() if now is None else as_column(now), F.col("latest_loaded_at"))
    tolerance = F.lit(max_lag_rows)

    stale = F.col("latest_loaded_at").isNull() | (age > max_load_age_minutes)
    stale_text = F.when(F.col("latest_loaded_at").isNull(), F.lit(NO_LOAD_TEXT)).otherwise(
        F.format_string(STALE_TEXT, age)
    )
    # condition, text, incident type, whether the finding is grave enough for an incident
    findings = [
        (
            bronze_gap != 0,
            F.format_string(BRONZE_TEXT, bronze, silver, quarantine, bronze_gap),
            BRONZE_RECONCILIATION,
            F.lit(strict) | (F.abs(bronze_gap) > tolerance),
        ),
        (
            raw_gap != 0,
            F.format_string(SILVER_RAW_TEXT, unique, raw, raw_gap),
            SILVER_RAW_RECONCILIATION,
            F.lit(strict) | (raw_gap < 0) | (raw_gap > tolerance),
        ),
        (raw != fact, F.format_string(RAW_FACT_TEXT, raw, fact), RAW_FACT_RECONCILIATION, F.lit(True)),
        (fact != gold, F.format_string(FACT_GOLD_TEXT, fact, gold), FACT_GOLD_RECONCILIATION, F.lit(True)),
        (stale, stale_text, WAREHOUSE_FRESHNESS, F.lit(True)),
    ]
    issues = F.array_compact(F.array(*[F.when(found, text) for found, text, _, _ in findings]))
    incidents = F.array_compact(
        F.array(*[F.when(found & grave, F.lit(kind)) for found, _, kind, grave in findings])
    )
    judged = metrics.select(
        "*", issues.alias("issues"), incidents.alias("incident_types"), age.alias("load_age_minutes")
    )
    status = (
        F.when(F.size("incident_types") > 0, "DEGRADED").when(F.size("issues") > 0, "WARNING").otherwise("HEALTHY")
    )
    details = F.when(F.size("issues") > 0, F.array_join("issues", "; ")).otherwise(ALL_GOOD_TEXT)
    return judged.select("*", status.alias("status"), details.alias("details"))


def metrics_row(verdict: DataFrame, recorded_at: Column | datetime) -> DataFrame:
    """The snapshot kept in the metrics history."""
    at = as_column(recorded_at)
    return verdict.select(
        F.date_format(at, "yyyyMMdd'T'HHmmss.SSSSSS").alias("metric_id"),
        at.alias("recorded_at"),
        "bronze_rows",
        "silver_rows",
        "silver_unique_events",
        "quarantine_rows",
        "raw_orders",
        "fact_orders",
        "gold_order_count",
        "latest_loaded_at",
        "status",
        "details",
    )


def incident_transitions(
    open_incidents: DataFrame,
    verdict: DataFrame,
    run_id: Column | str | None,
    now: Column | datetime,
    scope: Sequence[str] = (),
) -> DataFrame:
    """What a verdict does to the open incidents: OPEN, REFRESH or RESOLVE, one row each.

    With ``scope`` columns many verdicts are matched at once, each against the open
    incidents of its scope, and ``now`` and ``run_id`` are columns of the verdict
    (joined in per scope, since a resolved type has no finding to carry them).
    """
    keys = [*scope, "incident_type"]
    run, at = as_column(run_id).cast("string"), as_column(now)
    found = verdict.select(
        *scope,
        F.explode("incident_types").alias("incident_type"),
        "status",
        F.array_join("issues", "; ").alias("_details"),
        F.lit(True).alias("_active"),
    )
    standing = open_incidents.where("resolved_at IS NULL").select(
        *keys,
        "incident_id",
        "severity",
        "details",
        "opened_at",
        "opened_by_run_id",
        "alert_sent_at",
        F.lit(True).alias("_open"),
    )
    matched = found.join(standing, keys, "full_outer")
    if scope:
        matched = matched.join(verdict.select(*scope, run.alias("_run"), at.alias("_now")), list(scope), "inner")
    else:
        matched = matched.select("*", run.alias("_run"), at.alias("_now"))
    kind = (
        F.when(F.col("_open").isNull(), "OPEN").when(F.col("_active").isNull(), "RESOLVE").otherwise("REFRESH")
    )
    opening, resolving = F.col("transition") == "OPEN", F.col("transition") == "RESOLVE"
    new_id = F.sha2(
        F.concat_ws("|", *[F.col(c).cast("string") for c in scope], "incident_type", F.unix_micros("_now").cast("string")),
        256,
    )
    nothing = F.lit(None).cast("timestamp")
    return matched.withColumn("transition", kind).select(
        *scope,
        F.when(opening, new_id).otherwise(F.col("incident_id")).alias("incident_id"),
        "incident_type",
        F.when(resolving, F.col("severity")).otherwise(F.col("status")).alias("severity"),
        F.when(resolving, F.col("details")).otherwise(F.col("_details")).alias("details"),
        F.when(opening, F.col("_now")).otherwise(F.col("opened_at")).alias("opened_at"),
        F.when(resolving, F.col("_now")).alias("resolved_at"),
        F.when(opening, F.col("_run")).otherwise(F.col("opened_by_run_id")).alias("opened_by_run_id"),
        F.when(resolving, F.col("_run")).alias("resolved_by_run_id"),
        F.when(opening, nothing).otherwise(F.col("alert_sent_at")).alias("alert_sent_at"),
        nothing.alias("recovery_sent_at"),
        "transition",
        F.col("_now").alias("changed_at"),
    )


def pending_notices(transitions: DataFrame) -> DataFrame:
    """Who must be told: an alert when an incident opens, a recovery when it resolves, nothing between."""
    due = transitions.where(
        ((F.col("transition") == "OPEN") & F.col("alert_sent_at").isNull())
        | ((F.col("transition") == "RESOLVE") & F.col("recovery_sent_at").isNull())
    )
    return due.withColumn("notice", F.when(F.col("transition") == "OPEN", "ALERT").otherwise("RECOVERY"))


def stamp_notices(transitions: DataFrame, sent_at: Column | datetime) -> DataFrame:
    """The same transitions once their notices went out."""
    at = as_column(sent_at)
    return transitions.withColumns(
        {
            "alert_sent_at": F.when(F.col("transition") == "OPEN", at).otherwise(F.col("alert_sent_at")),
            "recovery_sent_at": F.when(F.col("transition") == "RESOLVE", at).otherwise(F.col("recovery_sent_at")),
        }
    )


def due_notices(incidents: DataFrame, stamps: DataFrame) -> DataFrame:
    """Notices that were never stamped, whatever became of the attempts: an alert for every incident that opened, a
    recovery for every one that was resolved.

    ``incidents``: the current state, one row each. Who hears of a recovery has heard the alert or hears it as well.
    """
    kinds = F.array(F.lit("ALERT"), F.when(F.col("resolved_at").isNotNull(), F.lit("RECOVERY")))
    owed = incidents.withColumn("notice", F.explode(F.array_compact(kinds)))
    unsent = owed.join(stamps.select("incident_id", "notice"), ["incident_id", "notice"], "left_anti")
    at = F.when(F.col("notice") == "ALERT", F.col("opened_at")).otherwise(F.col("resolved_at"))
    return unsent.select("incident_id", "incident_type", "notice", "severity", "details", at.alias("happened_at"))


def with_stamps(incidents: DataFrame, stamps: DataFrame) -> DataFrame:
    """Incidents with the times their notices first went out."""
    by_incident = stamps.groupBy("incident_id").agg(
        F.min(F.when(F.col("notice") == "ALERT", F.col("sent_at"))).alias("_alert"),
        F.min(F.when(F.col("notice") == "RECOVERY", F.col("sent_at"))).alias("_recovery"),
    )
    joined = incidents.join(by_incident, "incident_id", "left")
    later = {"alert_sent_at": "_alert", "recovery_sent_at": "_recovery"}
    return joined.select(*[F.coalesce(later[c], c).alias(c) if c in later else c for c in incidents.columns])
