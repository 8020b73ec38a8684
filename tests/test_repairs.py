"""Remediation outcomes, order-id repair and skewed groups, against plain Python."""

import json

import pytest
from pyspark.sql import functions as F

from builders import event, utc
from orderlake import schemas as S
from orderlake.operators.checks import Check, duplicate_business_keys, failing_rows, run_checks
from orderlake.operators.delivery import first_per_key, insert_absent, upsert
from orderlake.operators.key_repair import apply_overlay, repair_order_ids, verify_rewrite
from orderlake.operators.operations import (
    STARTED,
    current_runs,
    latest_metrics,
    metric_history,
    open_incidents,
    recent_runs,
    run_event,
    trend_summary,
)
from orderlake.operators.remediation import audit_rows, correction_value, parse_set_value, remediate

NOW = utc(2026, 8, 20)
BAD = {
    "event_id": "ev-mend",
    "event_timestamp": "2026-08-11T06:20:30.5+00:00",
    "order_id": "ORD-M1",
    "category": "books",
    "quantity": 0,
    "unit_price": 12.4,
}


def quarantine(spark, *payloads):
    rows = [(p, 1, None, "invalid_quantity", "orders", 0, i, NOW, NOW) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, S.QUARANTINE)


def outcomes(spark, corrections, payloads=None, **options):
    requests = spark.createDataFrame([("ev-mend", corrections)], S.REPAIR_REQUESTS)
    payloads = [event(**BAD)] if payloads is None else payloads
    return remediate(quarantine(spark, *payloads), requests, "b", NOW, **options).report.first()


def test_repair_keeps_identity_order_and_types(spark):
    row = outcomes(spark, {"quantity": "2", "note": "two boxes"})
    assert (row.outcome, row.repaired_order_id, row.matches) == ("REPAIRED", "ORD-M1", 1)
    want = {**json.loads(event(**BAD)), "quantity": 2, "note": "two boxes"}
    assert json.loads(row.repaired_payload) == want
    assert list(json.loads(row.repaired_payload)) == list(want)


@pytest.mark.parametrize(
    "corrections, outcome, error",
    [
        ({"event_id": "other", "quantity": "2"}, "PROTECTED_FIELD", None),
        ({"event_timestamp": "2026-08-17T00:00:00+00:00", "quantity": "2"}, "PROTECTED_FIELD", None),
        ({"event_id": "ev-mend", "quantity": "2"}, "REPAIRED", None),
        ({"schema_version": "99", "quantity": "2"}, "CONTRACT_FAILED", "contract_unsupported_schema_version"),
        ({"order_id": "null", "quantity": "2"}, "CONTRACT_FAILED", "contract_missing_order_id"),
        ({"quantity": "0"}, "QUALITY_FAILED", "invalid_quantity"),
        ({"quantity": '"2"'}, "QUALITY_FAILED", "invalid_quantity"),
        ({"quantity": "2", "unit_price": "-1.0"}, "QUALITY_FAILED", "invalid_unit_price"),
        ({"quantity": "2", "currency": "USD"}, "QUALITY_FAILED", "unsupported_currency"),
        ({"quantity": "2", "order_id": "7"}, "QUALITY_FAILED", "missing_order_id"),
        ({}, "QUALITY_FAILED", "invalid_quantity"),
        (None, "QUALITY_FAILED", "invalid_quantity"),
    ],
)
def test_refused_repairs(spark, corrections, outcome, error):
    row = outcomes(spark, corrections)
    assert (row.outcome, row.outcome_error) == (outcome, error)
    assert (row.repaired_payload is None) == (outcome != "REPAIRED")


def test_a_broken_timestamp_cannot_be_repaired(spark):
    broken = event(**{**BAD, "event_timestamp": "not-a-timestamp", "quantity": 2})
    assert outcomes(spark, {"category": "home"}, [broken]).outcome_error == "invalid_event_timestamp"


@pytest.mark.parametrize(
    "payloads, outcome",
    [
        ([], "NOT_FOUND"),
        ([event(**BAD)] * 2, "AMBIGUOUS"),
        (["not json", "null", "[1]", '"ev-mend"', event(event_id=7)], "NOT_FOUND"),
        ([None, event(**BAD)], "REPAIRED"),
    ],
)
def test_matching(spark, payloads, outcome):
    assert outcomes(spark, {"quantity": "2"}, payloads).outcome == outcome


def test_repeated_keys_in_a_payload_do_not_break_the_repair(spark):
    twice = event(**BAD).replace('"quantity": 0', '"quantity": 1, "quantity": 0')
    assert json.loads(outcomes(spark, {"quantity": "2"}, [twice]).repaired_payload)["quantity"] == 2


def test_requests_of_one_event_are_all_refused(spark):
    two = [("ev-mend", {"quantity": "2"}), ("ev-mend", {"quantity": "5"})]
    done = remediate(quarantine(spark, event(**BAD)), spark.createDataFrame(two, S.REPAIR_REQUESTS), "b", NOW)
    assert [r.outcome for r in done.report.collect()] == ["DUPLICATE_REQUEST"] * 2
    assert done.repaired.count() == done.audit.count() == 0


def test_correction_values(spark):
    texts = ["2", "12.4", "home", "true", "null", '"2"', "2 boxes", "-1.0", '{"a":1}', "[1,2]", "", "nul", "1e3", '{"a":\n1}']
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(F.to_json(correction_value(F.col("t")))).collect()]

    def plain(text):
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return text

    assert [json.loads(g) for g in got] == [plain(t) for t in texts]
    assert parse_set_value(" quantity = 2 ") == ("quantity", "2")
    for bad in ("quantity", "=2", " =2"):
        with pytest.raises(ValueError):
            parse_set_value(bad)


def test_audit_rows(spark):
    requests = spark.createDataFrame([("ev-mend", {"quantity": "2", "category": "home"})], S.REPAIR_REQUESTS)
    done = remediate(quarantine(spark, event(**BAD)), requests, "b", NOW)
    dry = done.audit.first()
    assert (dry.action, dry.status, dry.order_id, dry.original_validation_error) == (
        "DRY_RUN", "DRY_RUN", "ORD-M1", "invalid_quantity",
    )
    assert dry.corrections == '{"category":"home","quantity":2}'
    assert done.audit.first().reprocessing_id == dry.reprocessing_id
    failed = audit_rows(done.repaired, "b", NOW, publish=True, error_message="broker down").first()
    assert (failed.action, failed.status, failed.error_message) == ("PUBLISH", "PUBLISH_FAILED", "broker down")
    assert set(failed.asDict()) == set(S.AUDIT.fieldNames())


# --- order ids ----------------------------------------------------------------


def test_order_id_repair_rules(spark):
    silver = spark.createDataFrame(
        [("a", "O1", "f1"), ("a", "O1", "f2"), ("b", "O1", "f1"), ("b", "OX", "f1"), ("c", None, "f1"), ("d", "O4", "f1")],
        "event_id string, order_id string, file_path string",
    )
    wanted = [("a", "O1", "N1"), ("b", "O1", "N2"), ("c", "O3", "N3"), ("z", "O9", "N9")]
    repair = repair_order_ids(silver, spark.createDataFrame(wanted, S.ORDER_KEY_MAP))
    got = {r.event_id: (r.outcome, r.copies, r.files, r.unexpected_copies) for r in repair.report.collect()}
    assert got == {
        "a": ("READY", 2, 2, 0),
        "b": ("UNEXPECTED_ORDER_ID", 2, 1, 1),
        "c": ("UNEXPECTED_ORDER_ID", 1, 1, 1),
        "z": ("NO_MATCH", 0, 0, 0),
    }
    assert {(r.event_id, r.order_id) for r in repair.rows.collect()} == {("a", "N1")}
    after = sorted((r.event_id, r.order_id or "") for r in apply_overlay(silver, repair.report).collect())
    assert after == [("a", "N1"), ("a", "N1"), ("b", "O1"), ("b", "OX"), ("c", ""), ("d", "O4")]
    assert verify_rewrite(repair.report, repair.rows).count() == 0
    assert verify_rewrite(repair.report, repair.rows.limit(1)).count() == 1
    assert verify_rewrite(repair.report, silver).count() == 1


# --- whole results under skew ---------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one event, order and day."""
    hot = F.col("id") % 3 == 0
    return spark.range(9000).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 500)).alias("event_id"),
        F.when(hot, "O-hot").otherwise(F.concat(F.lit("O"), F.col("id") % 700)).alias("order_id"),
        (F.lit(9000) - F.col("id")).alias("position"),
        F.col("id").alias("row"),
    )


def test_first_per_key_and_insert_absent_against_brute_force(skewed):
    rows = skewed.collect()
    want = {}
    for r in sorted(rows, key=lambda r: r.position):
        want.setdefault(r.event_id, r.row)
    first = first_per_key(skewed, ["event_id"], ["position"])
    assert {r.event_id: r.row for r in first.collect()} == want
    known = first.where("event_id < 'e3'")
    expected = {e for e in want if not e < "e3"}
    assert {r.event_id for r in insert_absent(known, first).collect()} == expected
    merged = upsert(first, known.withColumn("row", F.lit(-1).cast("bigint")))
    assert {r.event_id: r.row for r in merged.collect()} == {e: -1 if e < "e3" else v for e, v in want.items()}


def test_duplicate_business_keys_against_brute_force(skewed):
    pairs = {}
    for r in skewed.collect():
        pairs.setdefault(r.order_id, set()).add(r.event_id)
    want = {k: len(v) for k, v in pairs.items() if len(v) > 1}
    got = {r.order_id: r.distinct_event_count for r in duplicate_business_keys(skewed).collect()}
    assert got == want and "O-hot" not in got and len(got) > 100


def test_every_check_counts_its_failing_rows(spark):
    rows = [("a", "x", 1, 5), ("a", "y", 0, 24), ("b", None, -2, 3), (None, "y", None, None), (None, "z", 4, 0)]
    table = spark.createDataFrame(rows, "event_id string, kind string, amount int, hour int")
    rules = [
        Check("not_null", "event_id"),
        Check("unique", "event_id"),
        Check("accepted_values", "kind", ("x",)),
        Check("positive", "amount"),
        Check("in_range", "hour", (0, 23)),
        Check("allowed", "kind", ("x", "y")),
        Check("one_event_per_key", "kind"),
    ]
    report = {r.rule: r.failing_rows for r in run_checks({"t": table}, {"t": rules}).collect()}
    assert report == {
        "not_null_event_id": 2,
        "unique_event_id": 1,
        "accepted_values_kind": 2,
        "positive_amount": 2,
        "in_range_hour": 1,
        "allowed_kind": 1,
        "one_event_per_key_kind": 0,
    }
    for rule in rules:
        assert failing_rows(table, rule).count() == report[rule.name]


# --- operations -----------------------------------------------------------------


def metrics(spark, *rows):
    return spark.createDataFrame(
        [(f"m{i}", at, 347, 342, unique, 5, raw, raw, raw, loaded, "HEALTHY", None) for i, (at, unique, raw, loaded) in enumerate(rows)],
        S.METRICS,
    )


def test_operations_views(spark):
    older, newer = utc(2026, 8, 20, 10, 0), utc(2026, 8, 20, 10, 10)
    loaded = utc(2026, 8, 19, 19, 46, 40)
    frame = metrics(spark, (newer, 340, 340, loaded), (older, 340, 339, None), (utc(2026, 8, 1), None, 1, loaded))
    row = latest_metrics(frame).first()
    assert (row.silver_duplicate_deliveries, row.silver_raw_lag, row.freshness_minutes) == (2, 0, 863)
    history = metric_history(frame).collect()
    assert [r.silver_raw_lag for r in history] == [1, 0] and history[0].freshness_minutes is None
    assert [r.silver_raw_lag for r in metric_history(frame, 1).collect()] == [0]
    trend = trend_summary(metric_history(frame), "silver_raw_lag", "freshness_minutes").collect()
    by_metric = {r.metric: (r.minimum, r.maximum, r.latest, r.snapshots) for r in trend}
    assert by_metric == {"silver_raw_lag": (0, 1, 0, 2), "freshness_minutes": (863, 863, 863, 1)}
    unknown = metrics(spark, (newer, None, 340, loaded))
    assert trend_summary(metric_history(unknown), "silver_raw_lag").count() == 0
    assert latest_metrics(frame.limit(0)).count() == 0


def test_runs_restart_from_a_clean_row(spark):
    at = [utc(2026, 8, 20, 10, m) for m in range(8)]
    events = [
        run_event(spark, "r1", at[0], started=True),
        run_event(spark, "r1", at[1], loader_files_loaded=3, raw_orders=9),
        run_event(spark, "r1", at[2], status="FAILED", error_message="x", finished_at=at[2]),
        run_event(spark, "r1", at[3], started=True),
        run_event(spark, "r1", at[4], loader_files_loaded=4),
        run_event(spark, "r2", at[5], started=True),
    ]
    ledger = events[0]
    for e in events[1:]:
        ledger = ledger.unionByName(e)
    assert ledger.where(F.col("event") == STARTED).count() == 3
    runs = {r.run_id: r for r in current_runs(ledger).collect()}
    first = runs["r1"]
    assert (first.status, first.loader_files_loaded, first.raw_orders) == ("RUNNING", 4, None)
    assert (first.error_message, first.finished_at) == (None, None)
    newest = recent_runs(current_runs(ledger), 1).collect()
    assert [(r.run_id, r.duration_seconds) for r in newest] == [("r2", None)]
    with pytest.raises(ValueError):
        run_event(spark, "r1", at[6], no_such_column=1)


def test_open_incidents_newest_first(spark):
    rows = [
        (f"i{n}", f"T{n}", "DEGRADED", "d", utc(2026, 8, n), utc(2026, 8, 9) if n == 2 else None, None, None, None, None, "OPEN", NOW)
        for n in (1, 2, 3)
    ]
    frame = spark.createDataFrame(rows, S.INCIDENTS)
    assert [r.incident_id for r in open_incidents(frame).collect()] == ["i3", "i1"]
