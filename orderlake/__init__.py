"""Order events to trusted daily sales, as Spark jobs."""

from orderlake.operators.checks import assert_constraints, duplicate_business_keys, failing_rows, run_checks
from orderlake.operators.delivery import current_state, first_deliveries, insert_absent, upsert
from orderlake.operators.health import (
    evaluate_health,
    incident_transitions,
    lake_metrics,
    pending_notices,
    warehouse_metrics,
)
from orderlake.operators.key_repair import repair_order_ids
from orderlake.operators.operations import (
    current_runs,
    latest_metrics,
    metric_history,
    open_incidents,
    recent_runs,
    remediation_history,
    trend_summary,
)
from orderlake.operators.reconcile import compare_cases, error_summary, offset_ranges, route_check
from orderlake.operators.remediation import remediate
from orderlake.operators.routing import (
    add_contract_error,
    add_quality_error,
    build_bronze,
    build_quarantine,
    build_silver,
    decode_tail,
    judge,
    parse_orders,
)
from orderlake.operators.windows import load_window, select_files
from orderlake.plans.load import run_load
from orderlake.plans.models import build_daily_sales, build_fact, stage_orders
from orderlake.plans.pipeline import record_run, register_models, run_pipeline
from orderlake.session import build_session
from orderlake.sources.tables import Paths
from orderlake.sources.topic import read_orders_stream
from orderlake.streaming.lake import start_lake, start_lake_single_pass, start_tail

__all__ = [
    "Paths",
    "add_contract_error",
    "add_quality_error",
    "assert_constraints",
    "build_bronze",
    "build_daily_sales",
    "build_fact",
    "build_quarantine",
    "build_session",
    "build_silver",
    "compare_cases",
    "current_runs",
    "current_state",
    "decode_tail",
    "duplicate_business_keys",
    "error_summary",
    "evaluate_health",
    "failing_rows",
    "first_deliveries",
    "incident_transitions",
    "insert_absent",
    "judge",
    "lake_metrics",
    "latest_metrics",
    "load_window",
    "metric_history",
    "offset_ranges",
    "open_incidents",
    "parse_orders",
    "pending_notices",
    "read_orders_stream",
    "recent_runs",
    "record_run",
    "register_models",
    "remediate",
    "remediation_history",
    "repair_order_ids",
    "route_check",
    "run_checks",
    "run_load",
    "run_pipeline",
    "select_files",
    "stage_orders",
    "start_lake",
    "start_lake_single_pass",
    "start_tail",
    "trend_summary",
    "upsert",
    "warehouse_metrics",
]
