"""Verdicts, incidents and notices."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from builders import utc
from orderlake import schemas as S
from orderlake.functions.scalars import age_minutes, freshness_minutes
from orderlake.operators.delivery import current_state
from orderlake.operators.health import (
    evaluate_health,
    incident_transitions,
    lake_metrics,
    metrics_row,
    pending_notices,
    stamp_notices,
    warehouse_metrics,
)

NOW = utc(2026, 8, 20, 12, 0)
B, S_RAW, R_F, F_G, W = (
    "BRONZE_RECONCILIATION",
    "SILVER_RAW_RECONCILIATION",
    "RAW_FACT_RECONCILIATION",
    "FACT_GOLD_RECONCILIATION",
    "WAREHOUSE_FRESHNESS",
)

# bronze, silver, unique, quarantine, raw, fact, gold; load age in minutes; options; status; incidents
CASES = [
    ((58, 58, None, 0, 58, 58, 58), 1, {}, "HEALTHY", []),
    ((61, 58, None, 0, 58, 58, 58), 1, {}, "WARNING", []),
    ((64, 58, None, 0, 58, 58, 58), 1, {}, "DEGRADED", [B]),
    ((61, 61, None, 0, 58, 58, 58), 1, {}, "WARNING", []),
    ((64, 64, None, 0, 58, 58, 58), 1, {}, "DEGRADED", [S_RAW]),
    ((58, 58, None, 0, 59, 59, 59), 1, {}, "DEGRADED", [S_RAW]),
    ((61, 58, None, 0, 58, 58, 58), 1, {"strict": True}, "DEGRADED", [B]),
    ((58, 58, None, 0, 58, 57, 57), 1, {}, "DEGRADED", [R_F]),
    ((58, 58, None, 0, 58, 58, 57), 1, {}, "DEGRADED", [F_G]),
    ((58, 58, None, 0, 58, 58, 58), 3000, {}, "DEGRADED", [W]),
    ((58, 58, None, 0, 58, 58, 58), None, {}, "DEGRADED", [W]),
    ((212, 208, 207, 4, 207, 207, 207), 1, {"strict": True}, "HEALTHY", []),
    ((212, 208, 208, 4, 207, 207, 207), 1, {"strict": True}, "DEGRADED", [S_RAW]),
    ((58, 58, None, 0, 58, 58, 58), 121, {"max_load_age_minutes": 120}, "DEGRADED", [W]),
    ((58, 58, None, 0, 58, 58, 58), 119, {"max_load_age_minutes": 120}, "HEALTHY", []),
    ((71, 58, None, 0, 58, 57, 56), None, {}, "DEGRADED", [B, R_F, F_G, W]),
]


def metrics(spark, counts, age):
    bronze, silver, unique, quarantine, raw, fact, gold = counts
    latest = None if age is None else NOW - timedelta(minutes=age)
    return spark.createDataFrame(
        [(bronze, silver, unique, quarantine, raw, fact, gold, latest)],
        "bronze_rows bigint, silver_rows bigint, silver_unique_events bigint, quarantine_rows bigint, "
        "raw_orders bigint, fact_orders bigint, gold_order_count bigint, latest_loaded_at timestamp",
    )


def verdict(spark, counts=(58, 58, None, 0, 58, 58, 58), age=1, **options):
    return evaluate_health(metrics(spark, counts, age), now=NOW, **{"max_lag_rows": 5, **options})


@pytest.mark.parametrize("counts, age, options, status, incidents", CASES)
def test_verdict(spark, counts, age, options, status, incidents):
    row = verdict(spark, counts, age, **options).first()
    assert (row.status, row.incident_types) == (status, incidents)
    assert row.load_age_minutes == age


def test_issue_texts(spark):
    row = verdict(spark, (64, 58, None, 0, 58, 57, 57), 3000).first()
    assert row.details == (
        "Bronze does not reconcile with Silver + Quarantine: 64 != 58 + 0 (gap=6); "
        "raw.orders does not reconcile with fct_orders: 58 != 57; "
        "Warehouse data is stale: 3000 minutes since latest load"
    )
    assert verdict(spark).first().details == "All reconciliation and freshness checks passed"


def test_default_thresholds(spark):
    at_edge = metrics(spark, (118, 58, None, 0, 58, 58, 58), 2880)
    assert evaluate_health(at_edge, now=NOW).first().status == "WARNING"
    beyond = metrics(spark, (119, 58, None, 0, 58, 58, 58), 2881)
    assert evaluate_health(beyond, now=NOW).first().incident_types == [B, W]


@pytest.mark.parametrize("option", ["max_lag_rows", "max_load_age_minutes"])
def test_negative_thresholds_are_refused(spark, option):
    with pytest.raises(ValueError):
        verdict(spark, **{option: -1})


def test_metrics_of_layers(spark):
    ids = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "event_id string")
    row = lake_metrics(ids.union(ids), ids, ids.limit(0)).first()
    assert (row.bronze_rows, row.silver_rows, row.silver_unique_events) == (8, 4, 2)
    assert (row.silver_duplicate_deliveries, row.quarantine_rows) == (2, 0)
    raw = ids.withColumn("loaded_at", F.lit(NOW))
    mart = spark.createDataFrame([], "order_count bigint")
    row = warehouse_metrics(raw, ids, mart).first()
    assert (row.raw_orders, row.fact_orders, row.gold_order_count) == (4, 4, 0)
    both = evaluate_health(lake_metrics(ids, ids, ids.limit(0)), warehouse_metrics(raw, ids, mart), NOW).first()
    assert both.incident_types == [S_RAW, F_G]


def test_age_is_cut_and_freshness_rounded(spark):
    then = NOW - timedelta(minutes=7, seconds=30)
    row = spark.range(1).select(
        age_minutes(F.lit(NOW), F.lit(then)).alias("age"), freshness_minutes(F.lit(NOW), F.lit(then)).alias("fresh")
    )
    assert tuple(row.first()) == (7, 8)


# --- incidents ---------------------------------------------------------------


def open_incidents(spark, *kinds):
    rows = [
        (f"id-{k}", k, "DEGRADED", "old", utc(2026, 8, 19), None, "old_run", None, utc(2026, 8, 19), None, "OPEN", utc(2026, 8, 19))
        for k in kinds
    ]
    return spark.createDataFrame(rows, S.INCIDENTS)


def test_opens_refreshes_and_resolves(spark):
    found = verdict(spark, (58, 58, None, 0, 58, 57, 56))
    rows = incident_transitions(open_incidents(spark, R_F, W), found, "run_2", NOW).collect()
    by_type = {r.incident_type: r for r in rows}
    assert {k: r.transition for k, r in by_type.items()} == {R_F: "REFRESH", F_G: "OPEN", W: "RESOLVE"}
    opened, refreshed, resolved = by_type[F_G], by_type[R_F], by_type[W]
    assert (opened.severity, opened.opened_by_run_id, opened.opened_at) == ("DEGRADED", "run_2", NOW.replace(tzinfo=None))
    assert opened.alert_sent_at is None and opened.resolved_at is None
    assert (refreshed.incident_id, refreshed.opened_by_run_id) == (f"id-{R_F}", "old_run")
    assert refreshed.details == found.first().details and refreshed.resolved_at is None
    assert (resolved.details, resolved.resolved_by_run_id) == ("old", "run_2")
    assert resolved.resolved_at == NOW.replace(tzinfo=None)


def test_nothing_to_do_when_healthy_and_quiet(spark):
    assert incident_transitions(open_incidents(spark), verdict(spark), "r", NOW).count() == 0


def test_resolved_incidents_do_not_count_as_open(spark):
    closed = open_incidents(spark, R_F).withColumn("resolved_at", F.lit(NOW))
    found = verdict(spark, (58, 58, None, 0, 58, 57, 57))
    assert [r.transition for r in incident_transitions(closed, found, "r", NOW).collect()] == ["OPEN"]


def test_alert_once_then_recovery(spark):
    bad, good = verdict(spark, (58, 58, None, 0, 58, 57, 57)), verdict(spark)
    first = stamp_notices(incident_transitions(open_incidents(spark), bad, "r1", NOW), NOW)
    assert first.first().alert_sent_at == NOW.replace(tzinfo=None)
    opened = incident_transitions(open_incidents(spark), bad, "r1", NOW)
    assert [r.notice for r in pending_notices(opened).collect()] == ["ALERT"]
    again = incident_transitions(first, bad, "r2", NOW + timedelta(minutes=10))
    assert pending_notices(again).count() == 0
    assert again.first().alert_sent_at == NOW.replace(tzinfo=None)
    over = incident_transitions(again, good, "r3", NOW + timedelta(minutes=20))
    assert [(r.notice, r.incident_id) for r in pending_notices(over).collect()] == [
        ("RECOVERY", first.first().incident_id)
    ]
    ledger = first.unionByName(again).unionByName(over)
    state = current_state(ledger, "incident_id", "changed_at").collect()
    assert len(state) == 1 and state[0].resolved_by_run_id == "r3"


def test_snapshot_row(spark):
    row = metrics_row(verdict(spark), NOW).first()
    assert row.asDict().keys() == set(S.METRICS.fieldNames())
    assert row.metric_id == "20260820T120000.000000"
