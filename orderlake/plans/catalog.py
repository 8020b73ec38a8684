"""Every operator as a query over the test tables.

All queries start from the delivery log derived from ``lineitem``
(``sources.sample``) and run over all of it. Control tables (ledgers, metrics,
runs, incidents, repair requests) are derived from the same deliveries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.operators import checks, health, key_repair, operations, reconcile, remediation
from orderlake.operators.delivery import current_state, first_deliveries, insert_absent, to_warehouse_row
from orderlake.operators.routing import build_bronze, build_quarantine, build_silver, decode_tail, judge
from orderlake.operators.windows import BACKFILL, NORMAL, REPLAY, LoadWindow, list_files, load_window, select_files
from orderlake.plans.load import count_load
from orderlake.plans.models import build_daily_sales, build_fact, fact_rows, newer_than_fact, stage_orders
from orderlake.session import pin_utc, scratch_root, stage
from orderlake.sources import files, sample
from orderlake.sources.tables import Paths, read_bronze, read_quarantine, read_silver
from orderlake.streaming.lake import start_lake

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the queries, repeated in the SQL they are checked against.
FIRST_LOAD = datetime(2002, 1, 1, tzinfo=timezone.utc)
SECOND_LOAD = datetime(2002, 1, 2, 0, 10, tzinfo=timezone.utc)
CHECKED_AT = datetime(2002, 1, 2, 12, 0, tzinfo=timezone.utc)
WATERMARK = (date(1999, 6, 30), 6)
RANGE_START, RANGE_END = "1996-03-01T00", "1997-02-28T23"
DAILY_LAG_ROWS = 2
LATEST_DAYS = 24

WINDOWS = {
    NORMAL: load_window(NORMAL, watermark=WATERMARK),
    BACKFILL: load_window(BACKFILL, start=RANGE_START, end=RANGE_END),
    REPLAY: load_window(REPLAY, start=RANGE_START, end=RANGE_END),
}


# --- the delivery log and the lake ------------------------------------------


class DeliveryLog:
    """The derived deliveries of one table folder, and the layers made from them. Building one runs no job."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = pin_utc(spark), sf_dir

    @cached_property
    def lineitem(self) -> DataFrame:
        return sample.read_lineitem(self.spark, self.sf_dir)

    @cached_property
    def messages(self) -> DataFrame:
        return sample.messages(self.lineitem)

    @cached_property
    def bronze(self) -> DataFrame:
        return build_bronze(self.messages, sample.ingest_time())

    @cached_property
    def judged(self) -> DataFrame:
        return judge(self.bronze)

    @cached_property
    def silver(self) -> DataFrame:
        """Silver as it is read back: the hour a number, with file positions."""
        positioned = sample.with_file_position(build_silver(self.judged))
        return positioned.withColumn("ingestion_hour", F.col("ingestion_hour").cast("int"))

    @cached_property
    def quarantine(self) -> DataFrame:
        return build_quarantine(self.judged)

    @cached_property
    def first_rows(self) -> DataFrame:
        return _first(self.silver)

    # What a real run finds stored. Queries that read one of these several times write it once, like the job whose
    # output it is; each query for itself.

    def _stored(self, name: str, rows: DataFrame) -> DataFrame:
        return stage(rows, f"{name}-{uuid.uuid4().hex}")

    @cached_property
    def stored_routes(self) -> DataFrame:
        """Where each message went."""
        accepted = F.col("contract_error").isNull() & F.col("validation_error").isNull()
        event = F.when(accepted, F.col("event_id")).alias("event_id")
        return self._stored("routes", self.judged.select("topic", "partition", "offset", event, accepted.alias("accepted")))

    @cached_property
    def stored_silver(self) -> DataFrame:
        return self._stored("silver", self.silver)

    @cached_property
    def stored_raw(self) -> DataFrame:
        return self._stored("raw", self.raw)

    @cached_property
    def verdicts(self) -> DataFrame:
        return self._stored("verdicts", _daily_verdicts(self))

    @cached_property
    def raw(self) -> DataFrame:
        return raw_of(self.first_rows)


def raw_of(first_rows: DataFrame) -> DataFrame:
    """Raw orders after two loads; the second brought what the first had lost or not seen."""
    loaded_at = F.when(_is_loaded(), F.lit(FIRST_LOAD)).otherwise(F.lit(SECOND_LOAD))
    return to_warehouse_row(first_rows.withColumn("loaded_at", loaded_at), "loaded_at")


def bronze_projection(log: DeliveryLog) -> DataFrame:
    return log.bronze


def quarantine_orders(log: DeliveryLog) -> DataFrame:
    return log.quarantine


def _first(rows: DataFrame) -> DataFrame:
    return first_deliveries(rows, sample.SAMPLE_ORDER)


def _money(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals as doubles, the form both engines print alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def silver_orders(log: DeliveryLog) -> DataFrame:
    return build_silver(log.judged)


def tail_decode(log: DeliveryLog) -> DataFrame:
    return decode_tail(log.messages)


def contract_errors(log: DeliveryLog) -> DataFrame:
    return log.judged.groupBy("contract_error").agg(F.count("*").alias("rows"))


def quality_errors(log: DeliveryLog) -> DataFrame:
    passed = log.judged.where("contract_error IS NULL")
    return passed.groupBy("validation_error").agg(F.count("*").alias("rows"))


def error_summary(log: DeliveryLog) -> DataFrame:
    return reconcile.error_summary(log.judged)


def rule_parity(log: DeliveryLog) -> DataFrame:
    """Messages per code: what the faults planted should give against what the rules found."""
    planted = reduce(
        lambda chain, item: chain.when(sample.fault() == item[0], item[1]),
        sample.EXPECTED_CODES.items(),
        F.when(F.lit(False), ""),
    ).otherwise("valid")
    expected = log.lineitem.groupBy(planted.alias("code")).agg(F.count("*").alias("n"))
    code = F.coalesce("contract_error", "validation_error", F.lit("valid"))
    actual = log.judged.groupBy(code.alias("code")).agg(F.count("*").alias("n"))
    return reconcile.compare_cases(expected, actual, "code", "n")


def route_reconciliation(log: DeliveryLog) -> DataFrame:
    routes = log.stored_routes
    return reconcile.route_check(log.bronze, routes.where("accepted"), routes.where("NOT accepted"))


def partition_offsets(log: DeliveryLog) -> DataFrame:
    layers = {"bronze": log.bronze, "silver": log.silver}
    ranges = [reconcile.offset_ranges(df).withColumn("layer", F.lit(name)) for name, df in layers.items()]
    return ranges[0].unionByName(ranges[1])


# --- loads -------------------------------------------------------------------


def _is_loaded() -> Column:
    """Which files earlier loads took: all up to the watermark day, but for every seventh day lost."""
    return (F.col("ingestion_date") <= F.lit(WATERMARK[0])) & (F.dayofmonth("ingestion_date") % 7 != 3)


def _file_ledger(rows: DataFrame) -> DataFrame:
    return list_files(rows.where(_is_loaded()))


def _raw_before(rows: DataFrame) -> DataFrame:
    return _first(rows.where(_is_loaded()))


def _load(rows: DataFrame, window: LoadWindow) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Marked files, first deliveries of the chosen files, and those of them that are new."""
    files = select_files(list_files(rows), window, _file_ledger(rows))
    chosen = files.where("selected").select("file_path")
    batch = _first(rows.where(window.predicate()).join(chosen, "file_path", "left_semi"))
    return files, batch, insert_absent(_raw_before(rows), batch)


def _inserted(mode: str) -> Callable[[DeliveryLog], DataFrame]:
    def query(log: DeliveryLog) -> DataFrame:
        new = _load(log.stored_silver, WINDOWS[mode])[2]
        rows = to_warehouse_row(new, "file_path").select(
            "event_id", "order_id", "event_date", "quantity", "order_value", "kafka_offset", "file_path"
        )
        return _money(rows, "order_value")

    return query


def raw_first_wins(log: DeliveryLog) -> DataFrame:
    raw = to_warehouse_row(log.first_rows)
    return _money(raw, "unit_price", "order_value")


def load_counters(log: DeliveryLog) -> DataFrame:
    """Counters of a load of each mode, and the watermark a normal load leaves."""
    rows = log.stored_silver
    reports = []
    for mode, window in WINDOWS.items():
        files, _, new = _load(rows, window)
        moved = F.lit(window.advances_watermark)
        counted = count_load(files).select(
            F.lit(mode).alias("mode"),
            "files_discovered",
            "files_skipped",
            "files_loaded",
            "rows_processed",
            F.lit(0).cast("bigint").alias("rows_inserted"),
            F.when(moved, F.col("last_partition.ingestion_date")).alias("watermark_date"),
            F.when(moved, F.col("last_partition.ingestion_hour")).alias("watermark_hour"),
        )
        inserted = new.agg(F.count("*").alias("rows_inserted")).withColumn("mode", F.lit(mode))
        reports += [counted, inserted]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)
    numbers = ("files_discovered", "files_skipped", "files_loaded", "rows_processed", "rows_inserted")
    merged = stacked.groupBy("mode").agg(
        *[F.max(c).alias(c) for c in numbers],
        F.max("watermark_date").alias("watermark_date"),
        F.max("watermark_hour").alias("watermark_hour"),
    )
    return merged.withColumn("duplicates", F.col("rows_processed") - F.col("rows_inserted"))


def silver_files(log: DeliveryLog) -> DataFrame:
    return list_files(log.silver)


def loaded_files(log: DeliveryLog) -> DataFrame:
    """Entries a backfill adds to the file ledger."""
    # A file lies in one partition: the listing holds what the ledger lists of the partitions loaded before.
    listed = log._stored("files", list_files(log.silver))
    files = select_files(listed, WINDOWS[BACKFILL], listed.where(_is_loaded()))
    return files.where("selected AND NOT loaded_before").select(
        "file_path", F.lit(S.DATASET).alias("dataset_name"), "ingestion_date", "ingestion_hour", "row_count"
    )


def current_watermark(log: DeliveryLog) -> DataFrame:
    """Newest watermark from one ledger entry per ingested partition."""
    versions = (
        log.silver
        .groupBy("ingestion_date", "ingestion_hour")
        .agg(F.max("ingested_at").alias("updated_at"))
        .select(
            F.lit(S.DATASET).alias("dataset_name"),
            F.col("ingestion_date").alias("watermark_date"),
            F.col("ingestion_hour").alias("watermark_hour"),
            "updated_at",
        )
    )
    return current_state(versions, "dataset_name", "updated_at")


# --- models ------------------------------------------------------------------


def _fact_before(raw: DataFrame) -> DataFrame:
    """The fact as built after the first load."""
    return fact_rows(stage_orders(raw)).where(F.col("loaded_at") == F.lit(FIRST_LOAD))


def stg_orders(log: DeliveryLog) -> DataFrame:
    return _money(stage_orders(log.raw), "unit_price", "order_value")


def fct_orders_incremental(log: DeliveryLog) -> DataFrame:
    """The rows one incremental build adds."""
    raw = log.stored_raw
    return _money(fact_rows(newer_than_fact(stage_orders(raw), _fact_before(raw))), "unit_price", "order_value")


def fct_orders_upsert(log: DeliveryLog) -> DataFrame:
    """The fact after an incremental build that also replaces stale rows of it."""
    raw = log.stored_raw
    stale = fact_rows(stage_orders(raw)).where(
        (F.col("loaded_at") == F.lit(SECOND_LOAD)) & (F.dayofmonth("event_date") == 3)
    )
    stale = stale.withColumns({"quantity": F.lit(0), "loaded_at": F.lit(FIRST_LOAD)})
    fact = build_fact(stage_orders(raw), _fact_before(raw).unionByName(stale))
    return _money(fact, "unit_price", "order_value")


def mart_daily_sales(log: DeliveryLog) -> DataFrame:
    fact = build_fact(stage_orders(log.raw))
    return _money(build_daily_sales(fact), "gross_revenue", "average_order_value")


def late_event_correction(log: DeliveryLog) -> DataFrame:
    """Business days the second load changed, before and after."""
    raw = log.stored_raw
    tagged = fact_rows(stage_orders(raw))
    before = build_daily_sales(_fact_before(raw))
    after = build_daily_sales(tagged)
    names = ("order_count", "units_sold", "gross_revenue", "average_order_value")
    old = before.select("event_date", *[F.col(c).alias(f"old_{c}") for c in names])
    new = after.select("event_date", *[F.col(c).alias(f"new_{c}") for c in names])
    both = new.join(old, "event_date", "left").where(~F.col("old_order_count").eqNullSafe(F.col("new_order_count")))
    return _money(both, *[f"{v}_{c}" for v in ("old", "new") for c in names[2:]])


# --- data tests --------------------------------------------------------------


def duplicate_business_keys(log: DeliveryLog) -> DataFrame:
    return checks.duplicate_business_keys(stage_orders(log.raw))


def data_test_report(log: DeliveryLog) -> DataFrame:
    raw = log.stored_raw
    staged = stage_orders(raw)
    return checks.run_checks({"raw_orders": raw, "stg_orders": staged, "fct_orders": build_fact(staged)})


def constraint_report(log: DeliveryLog) -> DataFrame:
    """What the raw table's constraints would refuse if all deliveries were inserted as they came."""
    rows = to_warehouse_row(log.stored_silver).withColumn("loaded_at", F.lit(FIRST_LOAD))
    return checks.run_checks({"raw_orders": rows}, {"raw_orders": checks.RAW_CONSTRAINTS})


# --- health ------------------------------------------------------------------


def _warehouse(log: DeliveryLog) -> DataFrame:
    raw = log.stored_raw
    fact = build_fact(stage_orders(raw))
    return health.warehouse_metrics(raw, fact, build_daily_sales(fact))


def _lake(log: DeliveryLog) -> DataFrame:
    routes = log.stored_routes
    return health.lake_metrics(log.bronze, routes.where("accepted"), routes.where("NOT accepted"))


def pipeline_health(log: DeliveryLog) -> DataFrame:
    """The verdict over the whole lake and warehouse, strict."""
    verdict = health.evaluate_health(_lake(log), _warehouse(log), CHECKED_AT, strict=True)
    return _flat(verdict)


def _daily_metrics(log: DeliveryLog) -> DataFrame:
    """One metrics snapshot per day: what arrived that day and how far it got.

    Bronze counts by the broker's day and the others by the ingest day, on some days
    the model builds ran short, and checks ran later in the month the later at night,
    so every finding occurs.
    """
    day = F.to_date("ingested_at")
    accepted = F.col("contract_error").isNull() & F.col("validation_error").isNull()
    arrived = log.bronze.groupBy(F.col("ingestion_date").alias("day")).agg(F.count("*").alias("bronze_rows"))
    built = ~((F.dayofmonth("day") == 13) & (F.col("first.partition") == 1))
    summed = built & ~((F.dayofmonth("day") == 17) & (F.col("first.partition") == 2))
    # One pass over the judged messages. By event and day first: a distinct count per day would gather a busy day's events
    # in one task; refused messages, which belong to no event here, are spread over keys of their own. The first delivery
    # of an event is the first of its first day.
    spread = F.concat(F.lit("refused "), F.col("offset") % 1024)
    # Events of a day are ordered as their files are: by hour, number of the file and place in it; the folder's name is the
    # same for all of an hour and stays out of what is sorted and sent. The hash of the key comes first, since sorting by
    # it compares numbers, not keys that begin alike.
    timed = log.judged.withColumns({"accepted": accepted, "day": day, "hour": F.hour("ingested_at")})
    keyed = timed.withColumn("key", F.when(F.col("accepted"), F.col("event_id")).otherwise(spread))
    file_number = F.when(F.col("day").isNotNull(), F.expr(sample.FILE_NUMBER)).alias("file_number")
    order = F.struct("hour", file_number, "offset", "quantity", "unit_price", "partition", "ingested_at")
    per_event = keyed.groupBy(F.xxhash64("key").alias("hash"), "accepted", "key", "day").agg(
        F.count("*").alias("rows"), F.min(order).alias("first")
    )
    is_first = F.col("accepted") & (
        F.row_number().over(Window.partitionBy("hash", "accepted", "key").orderBy("day")) == 1
    )
    ranked = per_event.withColumn("is_first", is_first)
    routed = ranked.groupBy("day").agg(
        F.sum(F.when(F.col("accepted"), F.col("rows"))).alias("silver_rows"),
        F.count_if("accepted").alias("silver_unique_events"),
        F.sum(F.when(~F.col("accepted"), F.col("rows"))).alias("quarantine_rows"),
        F.count_if("is_first").alias("raw_orders"),
        F.count_if(F.col("is_first") & built).alias("fact_orders"),
        F.count_if(F.col("is_first") & summed).alias("gold_order_count"),
        (F.max(F.when(F.col("is_first"), F.col("first.ingested_at"))) + F.expr("INTERVAL 10 MINUTES")).alias(
            "latest_loaded_at"
        ),
    )
    stacked = arrived.unionByName(routed, allowMissingColumns=True)
    counters = [c for c in stacked.columns if c not in ("day", "latest_loaded_at")]
    merged = stacked.groupBy("day").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counters],
        F.max("latest_loaded_at").alias("latest_loaded_at"),
    )
    hours = F.lit(24) + F.dayofmonth("day") * 2
    return merged.withColumn(
        "recorded_at", F.timestamp_seconds(F.unix_seconds(F.col("day").cast("timestamp")) + hours * 3600)
    )


def _daily_verdicts(log: DeliveryLog) -> DataFrame:
    daily = _daily_metrics(log)
    return health.evaluate_health(daily, now=F.col("recorded_at"), max_lag_rows=DAILY_LAG_ROWS)


def _flat(verdict: DataFrame) -> DataFrame:
    """Lists as text."""
    return verdict.withColumn("incident_types", F.array_join("incident_types", ",")).drop("issues")


def health_verdict(log: DeliveryLog) -> DataFrame:
    return _flat(_daily_verdicts(log))


def _transitions(log: DeliveryLog) -> DataFrame:
    """Each day's verdict against the incidents the day before left open."""
    verdicts = log.verdicts.withColumn("run_id", F.concat(F.lit("run-"), F.col("day")))
    kind = F.explode("incident_types").alias("incident_type")
    left_open = verdicts.select(
        F.date_add("day", 1).alias("day"),
        kind,
        F.col("status").alias("severity"),
        "details",
        F.col("recorded_at").alias("opened_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.col("run_id").alias("opened_by_run_id"),
        F.col("recorded_at").alias("alert_sent_at"),
    ).withColumn("incident_id", F.sha2(F.concat_ws("|", "incident_type", "opened_by_run_id"), 256))
    return health.incident_transitions(left_open, verdicts, F.col("run_id"), F.col("recorded_at"), scope=["day"])


def incident_transitions(log: DeliveryLog) -> DataFrame:
    return _transitions(log)


def pending_notices(log: DeliveryLog) -> DataFrame:
    due = health.pending_notices(_transitions(log))
    return due.select("day", "incident_type", "notice", "severity", "details", "changed_at")


def sent_notices(log: DeliveryLog) -> DataFrame:
    """Transitions per type with the times their notices went out."""
    sent = health.stamp_notices(_transitions(log), F.col("changed_at") + F.expr("INTERVAL 1 MINUTE"))
    return sent.groupBy("incident_type", "transition").agg(
        F.count("*").alias("n"),
        F.count("alert_sent_at").alias("alerts"),
        F.count("recovery_sent_at").alias("recoveries"),
        F.max("alert_sent_at").alias("last_alert"),
        F.max("recovery_sent_at").alias("last_recovery"),
    )


# --- operations --------------------------------------------------------------


def _metrics_ledger(log: DeliveryLog) -> DataFrame:
    """Stored snapshots; those before 1996 predate the duplicate-aware column."""
    rows = health.metrics_row(log.verdicts, F.col("recorded_at"))
    aware = F.when(F.year("recorded_at") >= 1996, F.col("silver_unique_events"))
    return rows.withColumn("silver_unique_events", aware)


def metrics_ledger(log: DeliveryLog) -> DataFrame:
    return _metrics_ledger(log)


def latest_metrics(log: DeliveryLog) -> DataFrame:
    return operations.latest_metrics(_metrics_ledger(log))


def metric_history(log: DeliveryLog) -> DataFrame:
    return operations.metric_history(_metrics_ledger(log), LATEST_DAYS)


def trend_summary(log: DeliveryLog) -> DataFrame:
    history = operations.metric_history(_metrics_ledger(log), LATEST_DAYS)
    metrics = ("silver_raw_lag", "silver_duplicate_deliveries", "freshness_minutes")
    return operations.trend_summary(history, *metrics)


def open_incidents(log: DeliveryLog) -> DataFrame:
    newest = current_state(_transitions(log), "incident_type", "changed_at")
    return operations.open_incidents(newest)


def _run_events(log: DeliveryLog) -> DataFrame:
    """Run ledger: one run per day; a run on the tenth failed at first and was started again."""
    daily = log.verdicts.withColumn("run_id", F.concat(F.lit("run-"), F.col("day")))
    retried, degraded = "dayofmonth(day) = 10", "status = 'DEGRADED'"

    def event(kind: str, minutes: int, only: str = "true", **columns: str) -> str:
        at = f"recorded_at + INTERVAL {minutes} MINUTES"
        if "error_message" in columns or "dbt_status" in columns:
            columns["finished_at"] = at
        values = [
            f"cast({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in S.RUN_COLUMNS
        ]
        return f"if({only}, struct(run_id, '{kind}' AS event, {at} AS event_at, {', '.join(values)}), NULL)"

    events = [
        event(operations.STARTED, -30, retried, status="'RUNNING'"),
        event(operations.UPDATED, -28, retried, loader_files_skipped="9", loader_files_loaded="9"),
        event(
            operations.UPDATED,
            -25,
            retried,
            status="'FAILED'",
            error_message="'Pipeline failed. Failed tasks: load'",
        ),
        event(operations.STARTED, 0, status="'RUNNING'"),
        event(
            operations.UPDATED,
            2,
            loader_files_loaded="1",
            loader_rows_processed="silver_rows",
            loader_rows_inserted="raw_orders",
            loader_duplicates="silver_rows - raw_orders",
        ),
        event(
            operations.UPDATED,
            5,
            degraded,
            status="'FAILED'",
            error_message="'Pipeline failed. Failed tasks: health'",
        ),
        event(
            operations.UPDATED,
            6,
            f"NOT ({degraded})",
            status="'SUCCEEDED'",
            dbt_status="'SUCCEEDED'",
            health_status="status",
            raw_orders="raw_orders",
            latest_load="latest_loaded_at",
        ),
    ]
    return daily.selectExpr(f"inline(array_compact(array({', '.join(events)})))")


def run_state(log: DeliveryLog) -> DataFrame:
    return operations.current_runs(_run_events(log))


def recent_runs(log: DeliveryLog) -> DataFrame:
    return operations.recent_runs(operations.current_runs(_run_events(log)), 5)


def control_constraints(log: DeliveryLog) -> DataFrame:
    """The control tables' constraints over their current state."""
    tables = {
        "pipeline_runs": operations.current_runs(_run_events(log)),
        "pipeline_incidents": current_state(_transitions(log), "incident_id", "changed_at"),
        "pipeline_metrics": _metrics_ledger(log),
    }
    rules = {
        "pipeline_runs": checks.RUN_CONSTRAINTS,
        "pipeline_incidents": checks.INCIDENT_CONSTRAINTS,
        "pipeline_metrics": checks.METRIC_CONSTRAINTS,
    }
    return checks.run_checks(tables, rules)


# --- remediation and repair --------------------------------------------------


def _repair_requests(log: DeliveryLog) -> DataFrame:
    """One request per event with a repairable fault, and some that must be refused."""
    lineitem = log.lineitem
    f, line = sample.fault(), F.col("l_linenumber")
    order_id = F.concat(F.lit("ORD-"), F.col("l_orderkey"))

    def fix(field: str, value: Column | str) -> Column:
        return F.create_map(F.lit(field), value if isinstance(value, Column) else F.lit(value))

    corrections = (
        F.when((f == sample.ZERO_QUANTITY) & (line == 2), fix("quantity", "0"))
        .when(f == sample.ZERO_QUANTITY, fix("quantity", "2"))
        .when(f == sample.USD, fix("currency", "GBP"))
        .when(f == sample.BAD_CATEGORY, fix("category", "home"))
        .when(f == sample.BAD_TYPE, fix("event_type", "order_created"))
        .when(f == sample.ZERO_PRICE, fix("unit_price", "12.4"))
        .when(f == sample.BAD_TIME, fix("event_timestamp", "2026-08-11T06:20:30+00:00"))
        .when(f == sample.NO_ORDER_ID, fix("order_id", order_id))
        .when(f.isin(sample.VERSION_99, sample.TEXT_VERSION), fix("schema_version", "1"))
        .when(f == sample.NO_VERSION, fix("quantity", "3"))
        .when(f == sample.EXTRA_FIELD, fix("quantity", "4"))
    )
    asked = lineitem.where((f >= sample.NO_VERSION) & (f <= sample.TEXT_VERSION) & (f != sample.BLANK_EVENT_ID))
    return (
        asked.groupBy("l_orderkey", "l_linenumber")
        .agg(F.count("*").alias("n"))
        .select(
            F.concat(F.lit("evt-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("event_id"),
            corrections.alias("corrections"),
        )
    )


def _remediation(log: DeliveryLog) -> remediation.Remediation:
    return remediation.remediate(
        log.quarantine, _repair_requests(log), "batch-1", CHECKED_AT, publish=True
    )


def quarantine_remediation(log: DeliveryLog) -> DataFrame:
    report = _remediation(log).report
    field = lambda name: F.get_json_object("repaired_payload", f"$.{name}")
    return report.select(
        "event_id",
        "matches",
        "outcome",
        "outcome_error",
        "repaired_order_id",
        field("event_timestamp").alias("event_timestamp"),
        field("quantity").cast("int").alias("quantity"),
        field("unit_price").cast("double").alias("unit_price"),
        field("category").alias("category"),
        field("currency").alias("currency"),
    )


def repaired_messages(log: DeliveryLog) -> DataFrame:
    """The repairs judged again as new deliveries: how the stream would route them."""
    repaired = _remediation(log).repaired
    again = judge(
        repaired.select(
            F.col("repaired_order_id").alias("kafka_key"),
            F.col("repaired_payload").alias("raw_payload"),
            F.lit(S.TOPIC).alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(0).cast("bigint").alias("offset"),
            F.lit(CHECKED_AT).alias("kafka_timestamp"),
            F.lit(CHECKED_AT).alias("ingested_at"),
        )
    )
    orders = build_silver(again)
    return orders.select("event_id", "order_id", "kafka_key", "event_date", "quantity", "unit_price", "order_value")


def remediation_audit(log: DeliveryLog) -> DataFrame:
    return _remediation(log).audit


def remediation_history(log: DeliveryLog) -> DataFrame:
    """Audit newest first, each row dated by its message."""
    audit = _remediation(log).audit.withColumn("created_at", F.col("original_kafka_timestamp"))
    history = operations.remediation_history(audit)
    return history.select("created_at", "event_id", "action", "status", "corrections")


def _order_key_map(log: DeliveryLog) -> DataFrame:
    """First lines of every seventh order get a new id; every third of these names a wrong old one."""
    lineitem = log.lineitem
    order_id = F.concat(F.lit("ORD-"), F.col("l_orderkey"))
    chosen = lineitem.where((F.col("l_orderkey") % 7 == 0) & (F.col("l_linenumber") == 1)).groupBy("l_orderkey")
    return chosen.agg(F.count("*").alias("n")).select(
        F.concat(F.lit("evt-"), F.col("l_orderkey"), F.lit("-1")).alias("event_id"),
        F.when(F.col("l_orderkey") % 21 == 0, F.lit("ORD-none")).otherwise(order_id).alias("old_order_id"),
        F.concat(order_id, F.lit("-R")).alias("new_order_id"),
    )


def order_key_repair(log: DeliveryLog) -> DataFrame:
    return key_repair.repair_order_ids(log.silver, _order_key_map(log)).report


def order_key_files(log: DeliveryLog) -> DataFrame:
    return key_repair.repair_order_ids(log.silver, _order_key_map(log)).files


def order_key_overlay(log: DeliveryLog) -> DataFrame:
    """All of Silver with the accepted repairs laid over it."""
    rows = log.stored_silver
    report = key_repair.repair_order_ids(rows, _order_key_map(log)).report
    return key_repair.apply_overlay(rows, report).select("event_id", "order_id", "partition", "offset")


# --- streaming ---------------------------------------------------------------


def stream_equals_batch(log: DeliveryLog) -> DataFrame:
    """Stream the deliveries into a lake and compare each layer, row for row, with the batch."""
    spark, sf_dir = log.spark, log.sf_dir
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    paths = Paths(f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}")
    source = spark.readStream.schema(lineitem.schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    topic = sample.messages(sample.by_day(source, files.size(spark, f"{sf_dir}/lineitem.parquet")))
    for query in start_lake(topic, paths, {"availableNow": True}, sample.ingest_time()):
        query.awaitTermination()
    bronze_rows = log.bronze
    verdicts = log.judged
    pairs = {
        "bronze": (read_bronze(spark, paths), bronze_rows),
        "silver": (
            read_silver(spark, paths),
            build_silver(verdicts).withColumn("ingestion_hour", F.col("ingestion_hour").cast("int")),
        ),
        "quarantine": (read_quarantine(spark, paths), build_quarantine(verdicts)),
    }
    reports = []
    for layer, (streamed, batch) in pairs.items():
        columns = batch.columns
        digest = F.xxhash64(*columns).alias("digest")
        both = streamed.select(digest, F.lit(1).alias("s"), F.lit(0).alias("b")).unionByName(
            batch.select(digest, F.lit(0).alias("s"), F.lit(1).alias("b"))
        )
        per_row = both.groupBy("digest").agg(F.sum("s").alias("s"), F.sum("b").alias("b"))
        reports.append(
            per_row.agg(
                F.lit(layer).alias("layer"),
                F.sum("s").alias("streamed_rows"),
                F.sum("b").alias("batch_rows"),
                F.coalesce(F.sum(F.abs(F.col("s") - F.col("b"))), F.lit(0)).alias("differing_rows"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), reports)


_ON_LOG: dict[str, Callable[[DeliveryLog], DataFrame]] = {
    "bronze_projection": bronze_projection,
    "tail_decode": tail_decode,
    "contract_errors": contract_errors,
    "quality_errors": quality_errors,
    "error_summary": error_summary,
    "rule_parity": rule_parity,
    "silver_orders": silver_orders,
    "quarantine_orders": quarantine_orders,
    "route_reconciliation": route_reconciliation,
    "partition_offsets": partition_offsets,
    "raw_first_wins": raw_first_wins,
    "silver_files": silver_files,
    "load_normal": _inserted(NORMAL),
    "load_backfill": _inserted(BACKFILL),
    "load_replay": _inserted(REPLAY),
    "load_counters": load_counters,
    "loaded_files": loaded_files,
    "current_watermark": current_watermark,
    "stg_orders": stg_orders,
    "fct_orders_incremental": fct_orders_incremental,
    "fct_orders_upsert": fct_orders_upsert,
    "mart_daily_sales": mart_daily_sales,
    "late_event_correction": late_event_correction,
    "duplicate_business_keys": duplicate_business_keys,
    "data_test_report": data_test_report,
    "constraint_report": constraint_report,
    "lake_metrics": _lake,
    "warehouse_metrics": _warehouse,
    "pipeline_health": pipeline_health,
    "health_verdict": health_verdict,
    "incident_transitions": incident_transitions,
    "pending_notices": pending_notices,
    "sent_notices": sent_notices,
    "metrics_ledger": metrics_ledger,
    "latest_metrics": latest_metrics,
    "metric_history": metric_history,
    "trend_summary": trend_summary,
    "open_incidents": open_incidents,
    "run_state": run_state,
    "recent_runs": recent_runs,
    "control_constraints": control_constraints,
    "quarantine_remediation": quarantine_remediation,
    "repaired_messages": repaired_messages,
    "remediation_audit": remediation_audit,
    "remediation_history": remediation_history,
    "order_key_repair": order_key_repair,
    "order_key_files": order_key_files,
    "order_key_overlay": order_key_overlay,
    "stream_equals_batch": stream_equals_batch,
}


def _bind(query: Callable[[DeliveryLog], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(DeliveryLog(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _bind(query) for name, query in _ON_LOG.items()}
