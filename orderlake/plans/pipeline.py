"""One run of the warehouse: load, gate, models and their tests, health, close."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.operators.checks import (
    DATA_TESTS,
    INCIDENT_CONSTRAINTS,
    METRIC_CONSTRAINTS,
    OPEN_INCIDENT_CONSTRAINTS,
    RUN_EVENT_CONSTRAINTS,
    assert_constraints,
    require,
    run_checks_on_changes,
)
from orderlake.operators.delivery import current_state
from orderlake.operators.health import (
    MAX_LAG_ROWS,
    MAX_LOAD_AGE_MINUTES,
    due_notices,
    evaluate_health,
    incident_transitions,
    metrics_row,
    pending_notices,
    require_raw_orders,
    warehouse_metrics,
    with_stamps,
)
from orderlake.operators.operations import run_event
from orderlake.operators.windows import LoadWindow
from orderlake.plans.distincts import maintained_lake_metrics
from orderlake.plans.load import LoadCounters, run_load
from orderlake.plans.models import daily_sales, refresh_daily_sales, refresh_fact, stage_orders
from orderlake.plans.repairs import record_positions
from orderlake.session import held
from orderlake.sources.tables import (
    Paths,
    fct_orders,
    raw_orders,
    read_table,
    write_run,
)
from orderlake.sources.versions import VersionedTable


class HealthDegraded(RuntimeError):
    """The health verdict of a run was DEGRADED."""


@dataclass(frozen=True)
class RunResult:
    counters: LoadCounters
    verdict: DataFrame
    transitions: DataFrame

    @property
    def notices(self) -> DataFrame:
        return pending_notices(self.transitions)


def read_models(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """The stored models, each as one whole version."""
    raw = raw_orders(spark, paths).read()
    return {
        "raw_orders": raw,
        "stg_orders": stage_orders(raw),
        "fct_orders": fct_orders(spark, paths).read(),
        "mart_daily_sales": daily_sales(spark, paths),
    }


def register_models(spark: SparkSession, paths: Paths) -> None:
    """The models as views for SQL, the staging model among them only a view."""
    for name, model in read_models(spark, paths).items():
        model.createOrReplaceTempView(name)


def incident_ledger(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_table(spark, paths.ledger("pipeline_incidents"), S.INCIDENTS, "run_id")


def _model_tests(spark: SparkSession, paths: Paths) -> VersionedTable:
    """Has versions only, and no rows: which folders of a table have passed its tests."""
    return VersionedTable(spark, paths.ledger("model_tests"), S.ORDER_KEY_MAP, "none")


def changes_report(table: VersionedTable, passed: set[str], names: Sequence[str]) -> tuple[DataFrame, set[str]]:
    """The report of the named models' tests over what a table holds besides folders that passed, and its folders now."""
    version = table.current()
    fresh_parts = [n for n, p in version.parts.items() if not passed.issuperset(p.covers)]
    fresh = table.read(version, fresh_parts)
    buckets = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # folder names; no row is read
    touched, whole = table.read(version, buckets=buckets), table.read(version)
    report = None
    for name in names:
        part = run_checks_on_changes(name, fresh, touched, whole, DATA_TESTS[name])
        report = part if report is None else report.unionByName(part)
    return report, version.covered()


def incident_state(spark: SparkSession, paths: Paths) -> DataFrame:
    """The incidents as they stand, with the times their notices went out."""
    state = current_state(incident_ledger(spark, paths), "incident_id", "changed_at")
    return with_stamps(state, notice_stamps(spark, paths))


def notice_stamps(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_table(spark, paths.ledger("incident_notices"), S.NOTICE_STAMPS, "stamp_id")


def owed_notices(spark: SparkSession, paths: Paths) -> DataFrame:
    """Notices of all runs that have not gone out; those that failed are among them until one succeeds."""
    state = current_state(incident_ledger(spark, paths), "incident_id", "changed_at")
    return due_notices(state, notice_stamps(spark, paths))


def mark_sent(spark: SparkSession, paths: Paths, notices: DataFrame, sent_at: datetime, stamp_id: str) -> None:
    """Stamp notices that went out; the same stamps written again replace themselves."""
    stamps = notices.select("incident_id", "notice", F.lit(sent_at).alias("sent_at"))
    write_run(held(stamps), paths.ledger("incident_notices"), "stamp_id", stamp_id)


def build_models(spark: SparkSession, paths: Paths, build_id: str, full_refresh: bool = False) -> None:
    """Staging tests, then the fact and its tests, then the mart; a failing test stops what follows.

    Rows that passed the tests once are not read again, but where they share a bucket or an order with new ones; a full
    refresh tests everything.
    """
    book = _model_tests(spark, paths)
    state = book.current()

    def test(table: VersionedTable, name: str, models: Sequence[str]) -> list[str]:
        passed = set() if full_refresh else set(state.notes.get(name, ()))
        report, folders = changes_report(table, passed, models)
        require(report)
        return sorted(folders)

    passed = {"raw_orders": test(raw_orders(spark, paths), "raw_orders", ("raw_orders", "stg_orders"))}
    refresh_fact(spark, paths, build_id, full_refresh)
    passed["fct_orders"] = test(fct_orders(spark, paths), "fct_orders", ("fct_orders",))
    book.commit(state, {}, passed)
    refresh_daily_sales(spark, paths)


def check_health(
    spark: SparkSession,
    paths: Paths,
    run_id: str,
    now: datetime,
    max_lag_rows: int = MAX_LAG_ROWS,
    max_load_age_minutes: int = MAX_LOAD_AGE_MINUTES,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Judge the stored layers, keep the snapshot, and move the incidents on."""
    models = read_models(spark, paths)
    lake = maintained_lake_metrics(spark, paths, run_id)
    warehouse = warehouse_metrics(models["raw_orders"], models["fct_orders"], models["mart_daily_sales"])
    verdict = held(evaluate_health(lake, warehouse, now, max_lag_rows, max_load_age_minutes, strict))
    snapshot = metrics_row(verdict, now)
    assert_constraints(snapshot, "pipeline_metrics", METRIC_CONSTRAINTS)
    write_run(snapshot, paths.ledger("pipeline_metrics"), "run_id", run_id)

    ledger = incident_ledger(spark, paths).where(F.col("run_id") != run_id)
    standing = with_stamps(current_state(ledger, "incident_id", "changed_at"), notice_stamps(spark, paths))
    transitions = held(incident_transitions(standing, verdict, run_id, now))
    assert_constraints(transitions, "pipeline_incidents", INCIDENT_CONSTRAINTS)
    still_open = transitions.where("resolved_at IS NULL")
    assert_constraints(still_open, "open_incidents", OPEN_INCIDENT_CONSTRAINTS)
    write_run(transitions.select(*S.INCIDENTS.fieldNames()), paths.ledger("pipeline_incidents"), "run_id", run_id)
    return verdict, transitions


def record_run(spark: SparkSession, paths: Paths, step: str, event: DataFrame) -> None:
    """Append one entry to the run ledger; the same step written again replaces itself."""
    assert_constraints(event, "pipeline_runs", RUN_EVENT_CONSTRAINTS)
    run_id = event.first().run_id
    write_run(event, paths.ledger("pipeline_runs"), "entry", f"{run_id}-{step}")


def read_runs(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_table(spark, paths.ledger("pipeline_runs"), S.RUN_EVENTS, "entry")


def run_pipeline(
    spark: SparkSession,
    paths: Paths,
    window: LoadWindow,
    run_id: str,
    now: datetime,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    **health_options,
) -> RunResult:
    """The whole run under one id; rows are stamped ``now``, ledger entries by ``clock``.

    A failure is recorded with the step that failed, and raised.
    """

    def note(step: str, **columns) -> None:
        record_run(spark, paths, step, run_event(spark, run_id, clock(), started=step == "start", **columns))

    note("start")
    step = "load"
    try:
        record_positions(spark, paths, run_id)
        counters = run_load(spark, paths, window, run_id, now)
        note("load", **counters.as_run_columns())
        step = "gate"
        n_raw, latest = require_raw_orders(read_models(spark, paths)["raw_orders"])
        step = "models"
        build_models(spark, paths, run_id)
        step = "health"
        verdict, transitions = check_health(spark, paths, run_id, now, **health_options)
        status = verdict.first().status
        if status == "DEGRADED":
            raise HealthDegraded(f"run {run_id}: {verdict.first().details}")
    except Exception:
        note("finish", status="FAILED", finished_at=clock(), error_message=f"Pipeline failed. Failed tasks: {step}")
        raise
    note(
        "finish",
        status="SUCCEEDED",
        finished_at=clock(),
        dbt_status="SUCCEEDED",
        health_status=status,
        raw_orders=n_raw,
        latest_load=latest,
    )
    return RunResult(counters, verdict, transitions)
