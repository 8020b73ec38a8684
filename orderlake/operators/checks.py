"""Data tests of the models and write constraints of the tables.

All row-level rules of a table are counted in one pass over it; only rules about
keys group the table, on the key column alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import schemas as S


class Check(NamedTuple):
    """A rule about one column.

    ``kind`` is not_null, positive, in_range or allowed (judged row by row), unique or
    one_event_per_key (judged per key), or accepted_values (judged per value).
    """

    kind: str
    column: str
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"


class CheckFailed(ValueError):
    """At least one rule has failing rows."""


def _not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


# The data tests of the models, by table.
DATA_TESTS: dict[str, list[Check]] = {
    "raw_orders": [
        Check("unique", "event_id"),
        *_not_null("event_id", "order_id", "product_id", "quantity", "order_value"),
    ],
    "stg_orders": [
        Check("unique", "event_id"),
        *_not_null("event_id", "order_id", "quantity", "order_value"),
        Check("accepted_values", "event_type", S.EVENT_TYPES),
        Check("accepted_values", "currency", S.CURRENCIES),
        Check("one_event_per_key", "order_id"),
    ],
    "fct_orders": [
        Check("unique", "event_id"),
        *_not_null("event_id", "order_id", "quantity", "order_value"),
        Check("positive", "order_value"),
    ],
}

# Primary key, NOT NULL and CHECK constraints of the tables.
RAW_CONSTRAINTS = [
    Check("unique", "event_id"),
    *_not_null(
        *[f for f in S.RAW_ORDERS.fieldNames() if f not in ("customer_id", "kafka_key", "kafka_timestamp", "ingested_at")]
    ),
]
WATERMARK_CONSTRAINTS = [
    *_not_null("dataset_name", "watermark_date", "watermark_hour", "updated_at"),
    Check("in_range", "watermark_hour", (0, 23)),
]
LOADED_FILE_CONSTRAINTS = [
    Check("unique", "file_path"),
    *_not_null("file_path", "dataset_name", "row_count", "loaded_at"),
]
METRIC_CONSTRAINTS = _not_null("metric_id", "recorded_at", "status")
# Of a ledger entry, and of the current state of the runs.
RUN_EVENT_CONSTRAINTS = [
    *_not_null("run_id", "event", "event_at"),
    Check("allowed", "status", S.RUN_STATUSES),
    Check("allowed", "dbt_status", S.MODEL_STATUSES),
    Check("allowed", "health_status", S.HEALTH_STATUSES),
]
RUN_CONSTRAINTS = [
    Check("unique", "run_id"),
    *_not_null("run_id", "started_at", "status"),
    *RUN_EVENT_CONSTRAINTS[3:],
]
INCIDENT_CONSTRAINTS = [
    Check("unique", "incident_id"),
    *_not_null("incident_type", "severity", "details", "opened_at"),
    Check("allowed", "severity", S.INCIDENT_SEVERITIES),
]
# Over the open incidents only: at most one per type.
OPEN_INCIDENT_CONSTRAINTS = [Check("unique", "incident_type")]
AUDIT_CONSTRAINTS = [
    *_not_null("event_id", "corrections", "action", "status", "created_at"),
    Check("allowed", "action", S.AUDIT_ACTIONS),
    Check("allowed", "status", S.AUDIT_STATUSES),
]


def _row_fails(check: Check) -> Column | None:
    """Failure condition of a row-level rule; NULL values only fail ``not_null``."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "positive":
        return c <= 0
    if check.kind == "in_range":
        return ~c.between(*check.values)
    if check.kind == "allowed":
        return c.isNotNull() & ~c.isin(*check.values)
    return None


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows, keys or values a rule objects to."""
    condition = _row_fails(check)
    c = F.col(check.column)
    if condition is not None:
        return df.where(condition)
    if check.kind == "unique":
        counts = df.where(c.isNotNull()).groupBy(check.column).agg(F.count("*").alias("n_records"))
        return counts.where("n_records > 1")
    if check.kind == "accepted_values":
        bad = df.where(c.isNotNull() & ~c.isin(*check.values))
        return bad.groupBy(check.column).agg(F.count("*").alias("n_records"))
    if check.kind == "one_event_per_key":
        return duplicate_business_keys(df, check.column)
    raise ValueError(f"unknown check {check.kind!r}")


def duplicate_business_keys(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Keys that more than one distinct event uses.

    Pairs are made distinct over both columns first, then counted per key in the
    tasks: a key shared by a third of all events is never gathered in one place, as
    a plain distinct count per key would do.
    """
    pairs = orders.where("event_id IS NOT NULL").select(key, "event_id").distinct()
    return pairs.groupBy(key).agg(F.count("*").alias("distinct_event_count")).where("distinct_event_count > 1")


def _count_table(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    by_row = [c for c in checks if _row_fails(c) is not None]
    parts = []
    if by_row:
        counted = df.agg(*[F.count_if(_row_fails(c)).alias(c.name) for c in by_row])
        pairs = [F.struct(F.lit(c.name).alias("rule"), F.col(c.name).alias("failing_rows")) for c in by_row]
        parts.append(counted.select(F.inline(F.array(*pairs))))
    for check in checks:
        if _row_fails(check) is None:
            n = failing_rows(df, check).agg(F.count("*").alias("failing_rows"))
            parts.append(n.select(F.lit(check.name).alias("rule"), "failing_rows"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(F.lit(table).alias("table_name"), "rule", "failing_rows")


def run_checks(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]] = DATA_TESTS) -> DataFrame:
    """Every rule as ``(table_name, rule, failing_rows)``."""
    reports = [_count_table(name, tables[name], rules) for name, rules in checks.items() if name in tables]
    report = reports[0]
    for part in reports[1:]:
        report = report.unionByName(part)
    return report


def run_checks_on_changes(
    table: str, fresh: DataFrame, touched: DataFrame, whole: DataFrame, checks: Sequence[Check]
) -> DataFrame:
    """The same report for a table that passed before some rows were added.

    Row rules look at the ``fresh`` rows only. A key that is there twice now has a fresh row: uniqueness is counted on the
    ``touched`` buckets of the table, and keys that hold one event on the rows of ``whole`` that share a key with a fresh
    row. Rules about the bucketed key read no other bucket.
    """
    report = None
    for check in checks:
        if check.kind == "unique":
            part = _count_table(table, touched, [check])
        elif check.kind == "one_event_per_key":
            keys = fresh.select(check.column).distinct()
            part = _count_table(table, whole.join(keys, check.column, "left_semi"), [check])
        else:
            continue
        report = part if report is None else report.unionByName(part)
    others = [c for c in checks if c.kind not in ("unique", "one_event_per_key")]
    if others:
        part = _count_table(table, fresh, others)
        report = part if report is None else report.unionByName(part)
    return report


def require(report: DataFrame) -> None:
    """Stop what follows if any rule failed."""
    failed = report.where("failing_rows > 0").orderBy("table_name", "rule").collect()  # at most one row per rule
    if failed:
        raise CheckFailed("; ".join(f"{r.table_name}.{r.rule}: {r.failing_rows}" for r in failed))


def assert_constraints(df: DataFrame, table: str, checks: Sequence[Check]) -> None:
    """Refuse a write that would break the table's constraints."""
    require(_count_table(table, df, checks))
