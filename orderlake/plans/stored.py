"""Queries that run the jobs on stored tables: the derived deliveries are loaded, built, repaired and counted for real.

Each works in a folder of its own below the shared scratch folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.operators import health, reconcile
from orderlake.operators.checks import INCIDENT_CONSTRAINTS, OPEN_INCIDENT_CONSTRAINTS, run_checks
from orderlake.operators.delivery import current_state, first_deliveries, to_warehouse_row
from orderlake.operators.key_repair import READY, repair_order_ids
from orderlake.operators.remediation import audit_rows, reprocessing_id, republished_positions
from orderlake.operators.routing import build_bronze
from orderlake.operators.windows import BACKFILL, load_window, select_files
from orderlake.operators.windows import list_files as files_of
from orderlake.plans import catalog
from orderlake.plans.catalog import CHECKED_AT, FIRST_LOAD, SECOND_LOAD, WINDOWS, DeliveryLog
from orderlake.plans.distincts import refresh_silver_events
from orderlake.plans.load import absent_events, run_load
from orderlake.plans.models import daily_sales, refresh_daily_sales, refresh_fact
from orderlake.plans.repairs import carry_order_ids
from orderlake.session import scratch_root, stage
from orderlake.sources import files, sample
from orderlake.sources.tables import (
    Paths,
    fct_orders,
    raw_orders,
    read_bronze,
    read_quarantine,
    read_silver,
    read_table,
)
from orderlake.sources.topic import to_messages
from orderlake.streaming.lake import start_lake, start_lake_single_pass

_EVENT_NUMBERS = r"evt-(\d+)-(\d+)"


def _own_paths(log: DeliveryLog, name: str) -> Paths:
    return Paths(f"{scratch_root(log.spark)}/{name}-{uuid.uuid4().hex}")


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- loads and models ----------------------------------------------------------


def load_into_buckets(log: DeliveryLog) -> DataFrame:
    """The rows a normal load adds to a stored raw table: insert-if-absent against the batch's buckets."""
    paths = _own_paths(log, "load")
    silver = stage(log.silver, f"silver-{uuid.uuid4().hex}")
    ledger = files_of(silver.where(catalog._is_loaded()))
    raw = raw_orders(log.spark, paths)
    before = to_warehouse_row(first_deliveries(silver.where(catalog._is_loaded()), sample.SAMPLE_ORDER))
    loaded = raw.commit(raw.current(), {"before": raw.write(before.withColumn("loaded_at", F.lit(FIRST_LOAD)), "before")})
    window = WINDOWS["NORMAL"]
    chosen = select_files(files_of(silver), window, ledger).where("selected").select("file_path")
    rows = silver.where(window.predicate()).join(chosen, "file_path", "left_semi")
    batch = stage(to_warehouse_row(first_deliveries(rows, sample.SAMPLE_ORDER)), f"batch-{uuid.uuid4().hex}")
    new = absent_events(raw, loaded, loaded.parts, batch).withColumn("loaded_at", F.lit(SECOND_LOAD))
    now = raw.commit(loaded, {"load": raw.write(new, "load")})
    added = raw.read(now, ["load"])
    return _money(added.select("event_id", "order_id", "event_date", "quantity", "order_value", "kafka_offset"), "order_value")


def _warehouse(log: DeliveryLog, name: str, raw_rows: DataFrame | None = None) -> Paths:
    """Raw orders of two loads, with a build of the fact and the mart after each."""
    paths = _own_paths(log, name)
    rows = stage(log.raw if raw_rows is None else raw_rows, f"raw-{uuid.uuid4().hex}")
    raw = raw_orders(log.spark, paths)
    for load, at in (("load-1", FIRST_LOAD), ("load-2", SECOND_LOAD)):
        raw.commit(raw.current(), {load: raw.write(rows.where(F.col("loaded_at") == F.lit(at)), load)})
        refresh_fact(log.spark, paths, load.replace("load", "build"))
        refresh_daily_sales(log.spark, paths)
    return paths


def fact_by_builds(log: DeliveryLog) -> DataFrame:
    """The stored fact after two builds, each row with the build that made it."""
    fact = fct_orders(log.spark, _warehouse(log, "fact")).read()
    return _money(fact.drop("bucket"), "unit_price", "order_value")


def mart_by_affected_days(log: DeliveryLog) -> DataFrame:
    """The stored mart after the second load brought late events for days the first had."""
    return _money(daily_sales(log.spark, _warehouse(log, "mart")), "gross_revenue", "average_order_value")


def applied_order_key_repair(log: DeliveryLog) -> DataFrame:
    """The fact after an order-id repair of rows loaded before, with the orders of its day in the mart."""
    # Messages are judged once: the loads and the repair read what was stored of Silver.
    silver = log.stored_silver
    paths = _warehouse(log, "repaired", catalog.raw_of(first_deliveries(silver, sample.SAMPLE_ORDER)))
    report = repair_order_ids(silver, catalog._order_key_map(log)).report
    ready = report.where(F.col("outcome") == READY).select("event_id", "new_order_id", "outcome")
    carry_order_ids(log.spark, paths, stage(ready, f"repair-{uuid.uuid4().hex}"))
    orders = daily_sales(log.spark, paths).select("event_date", F.col("order_count").alias("orders_of_day"))
    fact = fct_orders(log.spark, paths).read().select("event_id", "order_id", "event_date", "build_id")
    raw = raw_orders(log.spark, paths).read().select("event_id", F.col("order_id").alias("raw_order_id"))
    return fact.join(raw, "event_id", "left").join(orders, "event_date", "left")


def kept_up_distincts(log: DeliveryLog) -> DataFrame:
    """Rows and distinct events of Silver as two checks count them, the second only what came since."""
    paths = _own_paths(log, "distincts")
    columns = ("event_id", "ingestion_date", "ingestion_hour", "file_path", "row_index")  # a check reads no others
    silver = stage(log.silver.select(*columns), f"silver-{uuid.uuid4().hex}")
    stages = {"check-1": silver.where(F.year("ingestion_date") < 1997), "check-2": silver, "check-3": silver}
    counts = [(check, *refresh_silver_events(log.spark, paths, rows, check)) for check, rows in stages.items()]
    return log.spark.createDataFrame(counts, "check_id string, silver_rows bigint, silver_unique_events bigint")


# --- reconciliation ----------------------------------------------------------------


def route_faults(log: DeliveryLog) -> DataFrame:
    """Route counters of layers with messages lost, in both layers, and repeated."""
    key = ("topic", "partition", "offset")
    verdicts = stage(
        log.judged.select(*key, (F.col("contract_error").isNull() & F.col("validation_error").isNull()).alias("good")),
        f"routes-{uuid.uuid4().hex}",
    )
    good, bad = verdicts.where("good").select(*key), verdicts.where("NOT good").select(*key)
    silver = good.where("offset % 97 <> 5").unionByName(good.where("offset % 101 = 7"))
    quarantine = bad.unionByName(bad.where("offset % 89 = 3")).unionByName(good.where("offset % 83 = 2"))
    return reconcile.route_check_by_runs(verdicts.select(*key), silver, quarantine)


def positions_of_republished(log: DeliveryLog) -> DataFrame:
    """Where each of two publishes of every repair arrived; the later publish arrived first, every message twice."""
    repaired = stage(catalog._remediation(log).repaired, f"repaired-{uuid.uuid4().hex}")
    order = F.regexp_extract("event_id", _EVENT_NUMBERS, 1).cast("bigint")
    line = F.regexp_extract("event_id", _EVENT_NUMBERS, 2).cast("bigint")
    audits, arrivals = [], []
    for batch, start in (("batch-1", 10**9), ("batch-2", 0)):
        audits.append(audit_rows(repaired, batch, CHECKED_AT, publish=True))
        for again in (0, 10**10):
            sent = repaired.withColumn("partition", (order % 3).cast("int"))
            sent = sent.withColumn("offset", order * 8 + line + F.lit(start + again).cast("bigint"))
            messages = to_messages(sent, reprocessing_id(batch), "partition", "offset")
            arrivals.append(messages.withColumn("timestamp", F.lit(CHECKED_AT)))
    audit = reduce(DataFrame.unionByName, audits)
    bronze = build_bronze(reduce(DataFrame.unionByName, arrivals), F.lit(CHECKED_AT))
    return republished_positions(audit, bronze)


# --- incidents --------------------------------------------------------------------


def _incident_state(log: DeliveryLog) -> DataFrame:
    return current_state(catalog._transitions(log).drop("day"), "incident_id", "changed_at")


def due_notices(log: DeliveryLog) -> DataFrame:
    """Notices still owed when those of some days went out and the others failed."""
    state = stage(_incident_state(log), f"incidents-{uuid.uuid4().hex}")

    def sent(notice: str, at: str, only: Column) -> DataFrame:
        return state.where(only).select("incident_id", F.lit(notice).alias("notice"), F.col(at).alias("sent_at"))

    alerts = sent("ALERT", "opened_at", F.dayofmonth("opened_at") % 2 == 0)
    recoveries = sent("RECOVERY", "resolved_at", F.dayofmonth("resolved_at") % 3 == 0)
    return health.due_notices(state, alerts.unionByName(recoveries))


def incident_constraints(log: DeliveryLog) -> DataFrame:
    """The incidents' constraints over a ledger in which one in three open incidents has a twin and some an id twice."""
    state = stage(_incident_state(log), f"incidents-{uuid.uuid4().hex}")
    open_now = state.where("resolved_at IS NULL")
    scoped = open_now.withColumn("incident_type", F.concat_ws("/", "incident_type", F.to_date("changed_at")))
    twins = scoped.where(F.dayofmonth("changed_at") % 3 == 0)
    twice = state.where(F.dayofmonth("changed_at") == 11)
    return run_checks(
        {"pipeline_incidents": state.unionByName(twice), "open_incidents": scoped.unionByName(twins)},
        {"pipeline_incidents": INCIDENT_CONSTRAINTS, "open_incidents": OPEN_INCIDENT_CONSTRAINTS},
    )


# --- the streamed lake ---------------------------------------------------------------


def _deliver(log: DeliveryLog, rows: DataFrame, folder: str) -> None:
    """Add rows of the table to a topic's folder, each day in one file: the streams that read it need no shuffle."""
    table = f"{log.sf_dir}/lineitem.parquet"
    sample.by_day(rows, files.size(log.spark, table)).write.mode("append").parquet(folder)


def _topic(log: DeliveryLog, folder: str) -> DataFrame:
    """The deliveries of a topic's folder as a stream."""
    schema = log.spark.read.parquet(f"{log.sf_dir}/lineitem.parquet").schema
    return sample.messages(log.spark.readStream.schema(schema).parquet(folder))


def streamed_loads(log: DeliveryLog) -> DataFrame:
    """What two loads take from a lake that is streamed half, loaded, streamed on after a restart, and loaded again."""
    paths = _own_paths(log, "streamed")
    table = log.spark.read.parquet(f"{log.sf_dir}/lineitem.parquet")
    window = {"load-1": load_window(), "load-2": load_window(BACKFILL, start="1900-01-01T00", end="2100-01-01T00")}
    counts = []
    for half, load in enumerate(window):
        _deliver(log, table.where(F.col("l_orderkey") % 2 == half), f"{paths.root}/topic")
        for query in start_lake(_topic(log, f"{paths.root}/topic"), paths, {"availableNow": True}, sample.ingest_time()):
            query.awaitTermination()
        done = run_load(log.spark, paths, window[load], load, CHECKED_AT)
        counts.append((load, done.rows_processed, done.rows_inserted))
    ledger = read_table(log.spark, paths.ledger("loaded_files"), S.LOADED_FILES, "load_id")
    by_hour = ledger.groupBy("load_id", "ingestion_date", "ingestion_hour").agg(F.sum("row_count").alias("row_count"))
    totals = log.spark.createDataFrame(counts, "load_id string, rows_processed bigint, rows_inserted bigint")
    return by_hour.join(totals, "load_id")


def committed_batches(log: DeliveryLog) -> DataFrame:
    """Rows per layer and day that readers of a single-pass lake see while a second batch is half written."""
    paths = _own_paths(log, "single")
    table = log.spark.read.parquet(f"{log.sf_dir}/lineitem.parquet")
    _deliver(log, table, f"{paths.root}/topic")
    start_lake_single_pass(
        _topic(log, f"{paths.root}/topic"), paths, {"availableNow": True}, sample.ingest_time()
    ).awaitTermination()
    for layer, read in (("bronze", read_bronze), ("silver", read_silver)):  # of a batch that was never committed
        rows = read(log.spark, paths).limit(100).drop("ingestion_date", "ingestion_hour")
        rows.write.parquet(f"{paths.lake(layer)}/batch_id=1/ingestion_date=1999-01-01/ingestion_hour=00" if layer == "silver"
                           else f"{paths.lake(layer)}/batch_id=1/ingestion_date=1999-01-01")
    days = {"bronze": F.col("ingestion_date"), "silver": F.col("ingestion_date"), "quarantine": F.to_date("ingested_at")}
    readers = {"bronze": read_bronze, "silver": read_silver, "quarantine": read_quarantine}
    parts = [
        read(log.spark, paths).groupBy(days[layer].alias("day")).agg(F.count("*").alias("rows")).withColumn("layer", F.lit(layer))
        for layer, read in readers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_ON_LOG: dict[str, Callable[[DeliveryLog], DataFrame]] = {
    query.__name__: query
    for query in (
        load_into_buckets,
        fact_by_builds,
        mart_by_affected_days,
        applied_order_key_repair,
        kept_up_distincts,
        route_faults,
        positions_of_republished,
        due_notices,
        incident_constraints,
        streamed_loads,
        committed_batches,
    )
}


def _bind(query: Callable[[DeliveryLog], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(DeliveryLog(spark, sf_dir))


QUERIES = {name: _bind(query) for name, query in _ON_LOG.items()}
