"""Remediation and order-id repair as jobs that write."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.operators.checks import AUDIT_CONSTRAINTS, Check, assert_constraints
from orderlake.operators.delivery import current_state, first_per_key
from orderlake.operators.key_repair import READY, KeyRepair, apply_overlay, repair_order_ids, verify_rewrite
from orderlake.operators.remediation import (
    audit_rows,
    remediate,
    reprocessing_id,
    republished_positions,
    with_positions,
)
from orderlake.plans.models import refresh_daily_sales
from orderlake.session import stage, unstage
from orderlake.sources.tables import (
    Paths,
    fct_orders,
    raw_orders,
    read_arrivals,
    read_quarantine,
    read_silver,
    read_table,
    with_metadata_position,
    write_run,
)
from orderlake.sources.topic import publish as publish_messages
from orderlake.sources.topic import to_messages
from orderlake.sources.versions import VersionedTable

def run_remediation(
    spark: SparkSession,
    paths: Paths,
    requests: DataFrame,
    batch_id: str,
    now: datetime,
    publish: bool = False,
    sink: dict[str, Any] | None = None,
) -> DataFrame:
    """Repair a batch of requests; without ``publish`` only the audit is written.

    The repaired payloads are staged first, so what is published is what was judged.
    A failed publish is audited as such and raised. Returns the report.
    """
    result = remediate(
        read_quarantine(spark, paths), stage(requests, f"requests-{batch_id}"), batch_id, now, publish
    )
    report = stage(result.report, f"remediation-{batch_id}")
    repaired = report.where(F.col("outcome") == "REPAIRED")
    log = paths.ledger("event_reprocessing_log")

    def write_audit(error: str | None = None) -> None:
        audit = audit_rows(repaired, batch_id, now, publish, error)
        assert_constraints(audit, "event_reprocessing_log", AUDIT_CONSTRAINTS)
        write_run(audit, log, "batch_id", batch_id)

    if publish:
        try:
            publish_messages(to_messages(repaired, reprocessing_id(batch_id)), **(sink or {}))
        except Exception as error:
            write_audit(str(error))
            raise
    write_audit()
    return report


def read_audit(spark: SparkSession, paths: Paths) -> DataFrame:
    """The audit, each published repair with the position it arrived at once that is recorded."""
    audit = read_table(spark, paths.ledger("event_reprocessing_log"), S.AUDIT, "batch_id")
    positions = read_table(spark, paths.ledger("republished_positions"), S.POSITIONS, "record_id")
    return with_positions(audit, first_per_key(positions, ["reprocessing_id"], ["record_id"]))


def record_positions(spark: SparkSession, paths: Paths, record_id: str) -> int:
    """Note where published repairs arrived that have no position yet; audit rows stay as they were written.

    Reads Bronze from the day before the oldest of them on (the broker's clock may be behind ours). How many were found.
    """
    waiting = read_audit(spark, paths).where("status = 'PUBLISHED' AND republished_offset IS NULL")
    oldest = waiting.agg(F.to_date(F.min("created_at"))).first()[0]
    if oldest is None:
        return 0
    arrivals = read_arrivals(spark, paths).where(F.col("ingestion_date") >= F.date_sub(F.lit(oldest), 1))
    found = stage(republished_positions(waiting, arrivals), f"positions-{record_id}")
    try:
        n = found.count()
        if n:
            write_run(found, paths.ledger("republished_positions"), "record_id", record_id)
        return n
    finally:
        unstage(spark, f"positions-{record_id}")


def applied_repairs(spark: SparkSession, paths: Paths) -> DataFrame:
    """The newest applied order-id repair per event."""
    ledger = read_table(spark, paths.ledger("order_key_repairs"), S.ORDER_KEY_REPAIRS, "repair_id")
    return current_state(ledger, "event_id", ["applied_at", "repair_id"])


def _rewrite_orders(table: VersionedTable, repairs: DataFrame, remade: Mapping[str, str]) -> dict[str, str]:
    """Put new order ids into a stored table: which folder took the place of which.

    Only buckets of the repaired events are searched, and only parts that hold one are written again, as a new version.
    ``remade``: folders of the table it was made from that were replaced likewise.
    """
    base = table.current()
    held = table.read(base, buckets=table.buckets_of(repairs)).select("event_id", "order_id", table.part_column)
    stale = held.join(repairs, "event_id").where("NOT order_id <=> new_order_id").select(table.part_column).distinct()
    names = [r[0] for r in stale.collect()]  # names of loads or builds
    sources = {n: tuple(dict.fromkeys(remade.get(f, f) for f in p.sources)) for n, p in base.parts.items()}
    changes = {n: replace(p, sources=sources[n]) for n, p in base.parts.items() if sources[n] != p.sources}
    if names:
        changes |= table.write_parts(apply_overlay(table.read(base, names), repairs), names, sources)
    if changes:
        table.commit(base, changes)
    return {old: new for n in names for old in base.parts[n].covers for new in changes[n].covers}


def carry_order_ids(spark: SparkSession, paths: Paths, repairs: DataFrame) -> None:
    """Bring repaired order ids into the rows that were loaded before: raw, fact, and the mart's record of the fact.

    Each table changes as a whole. After a failure between them the next build makes the fact's parts again from raw; so
    does running the repair again, which finds nothing left to change where it is done.
    """
    remade = _rewrite_orders(raw_orders(spark, paths), repairs, {})
    _rewrite_orders(fct_orders(spark, paths), repairs, remade)
    refresh_daily_sales(spark, paths)


def run_order_key_repair(
    spark: SparkSession, paths: Paths, key_map: DataFrame, repair_id: str, now: datetime, apply: bool = False
) -> KeyRepair:
    """Check an order-id repair and, with ``apply``, record it for every later read of Silver and carry it into the
    warehouse.

    As in a dry run of one event, any event without copies or with an unexpected id
    stops the whole repair.
    """
    key_map = stage(key_map, f"key-map-{repair_id}")
    assert_constraints(key_map, "order_key_map", [Check("unique", "event_id"), Check("not_null", "new_order_id")])
    repair = repair_order_ids(with_metadata_position(read_silver(spark, paths)), key_map)
    if not apply:
        return repair
    report = stage(repair.report, f"order-keys-{repair_id}")
    refused = report.where(F.col("outcome") != READY)
    if not refused.isEmpty():
        raise ValueError(f"repair refused for {refused.count()} event(s)")
    rows = stage(repair.rows, f"order-key-rows-{repair_id}")
    if not verify_rewrite(report, rows).isEmpty():
        raise ValueError("rewritten rows do not match the report; nothing applied")
    entries = report.select("event_id", "old_order_id", "new_order_id", "outcome", F.lit(now).alias("applied_at"))
    write_run(entries, paths.ledger("order_key_repairs"), "repair_id", repair_id)
    carry_order_ids(spark, paths, report.select("event_id", "new_order_id", "outcome"))
    return KeyRepair(report, repair.files, rows)
