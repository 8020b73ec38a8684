"""The lake and the warehouse on real files: streams, loads, models, health, repairs."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from builders import event, utc
from orderlake import schemas as S
from orderlake.operators.checks import CheckFailed
from orderlake.operators.delivery import current_state
from orderlake.operators.operations import current_runs, metric_history, recent_runs
from orderlake.operators.windows import load_window
from orderlake.plans.load import current_watermark, run_load
from orderlake.plans.models import refresh_daily_sales, refresh_fact
from orderlake.plans.pipeline import HealthDegraded, check_health, read_models, read_runs, register_models, run_pipeline
from orderlake.plans.repairs import read_audit, record_positions, run_order_key_repair, run_remediation
from orderlake.sources import sample
from orderlake.sources.tables import (
    daily_totals,
    fct_orders,
    raw_orders,
    read_bronze,
    read_quarantine,
    read_silver,
    read_table,
    write_run,
)
from orderlake.sources.topic import read_orders_stream
from orderlake.streaming.lake import start_lake_single_pass, start_tail

T0 = utc(2026, 8, 19, 12, 30)


def orders(*ids, **changes):
    return [event(event_id=f"evt-{i}", order_id=f"ORD-{i}", **changes) for i in ids]


def normal(spark, paths):
    return load_window(watermark=current_watermark(spark, paths))


def counts(spark, paths):
    models = read_models(spark, paths)
    sales = models["mart_daily_sales"].agg(F.sum("order_count")).first()[0]
    return models["raw_orders"].count(), models["fct_orders"].count(), sales


def day(spark, paths, on):
    row = read_models(spark, paths)["mart_daily_sales"].where(F.col("event_date") == F.lit(on)).first()
    return row.order_count, row.units_sold, float(row.gross_revenue), float(row.average_order_value)


def test_streams_route_and_resume(spark, paths, deliver):
    deliver([*orders(1, 2), "not json", *orders(3, quantity=0)], T0)
    deliver(orders(4), T0 + timedelta(hours=1))
    bronze, silver, quarantine = (f(spark, paths) for f in (read_bronze, read_silver, read_quarantine))
    assert (bronze.count(), silver.count(), quarantine.count()) == (5, 3, 2)
    assert {r.event_id for r in silver.collect()} == {"evt-1", "evt-2", "evt-4"}
    assert {(r.ingestion_date, r.ingestion_hour) for r in silver.collect()} == {
        (date(2026, 8, 19), 12),
        (date(2026, 8, 19), 13),
    }
    codes = {(r.contract_error, r.validation_error) for r in quarantine.collect()}
    assert codes == {("contract_invalid_payload", None), (None, "invalid_quantity")}


def test_bronze_is_dated_by_broker_and_silver_by_ingest(spark, paths, deliver):
    deliver(orders(1), utc(2026, 8, 20, 0, 10), kafka_at=utc(2026, 8, 19, 23, 50))
    assert read_bronze(spark, paths).first().ingestion_date == date(2026, 8, 19)
    assert read_silver(spark, paths).first().ingestion_date == date(2026, 8, 20)


def test_stray_files_do_not_count(spark, paths, deliver):
    deliver(orders(1, 2), T0)
    stray = f"{paths.lake('silver')}/ingestion_date=2026-08-19/ingestion_hour=12/stray.parquet"
    read_silver(spark, paths).drop("ingestion_date", "ingestion_hour").write.parquet(stray)
    assert read_silver(spark, paths).count() == 2


def test_a_missing_committed_file_is_an_error(spark, paths, deliver):
    deliver(orders(1, 2), T0)
    silver = read_silver(spark, paths)
    os.remove(silver.inputFiles()[0].removeprefix("file://"))
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        read_silver(spark, paths).agg(F.count_distinct("event_id")).collect()


def test_older_files_may_lack_columns(spark, paths):
    path = paths.ledger("pipeline_metrics")
    whole = spark.createDataFrame([("m1", T0, 1, 1, 1, 0, 1, 1, 1, T0, "HEALTHY", None)], S.METRICS)
    whole.drop("silver_unique_events").write.parquet(path)
    whole.write.mode("append").parquet(path)
    rows = read_table(spark, path, S.METRICS).collect()
    assert sorted(r.silver_unique_events or 0 for r in rows) == [0, 1]
    assert metric_history(read_table(spark, path, S.METRICS)).count() == 1


def test_single_pass_stream_writes_each_batch_once(spark, paths, deliver):
    deliver(["not json", *orders(1, 2)], T0)
    other = type(paths)(paths.root + "-single")
    for _ in range(2):
        stream = read_orders_stream(spark, "parquet", path=deliver.topic)
        start_lake_single_pass(stream, other, {"availableNow": True}, F.lit(T0)).awaitTermination()
    for read in (read_bronze, read_silver, read_quarantine):
        assert sorted(map(str, read(spark, other).collect())) == sorted(map(str, read(spark, paths).collect()))


def test_tail_shows_decoded_messages(spark, deliver):
    deliver(orders(1), T0)
    query = start_tail(read_orders_stream(spark, "parquet", path=deliver.topic), "memory", "tail_test")
    query.processAllAvailable()
    query.stop()
    row = spark.table("tail_test").first()
    assert (row.event_id, row.quantity, "schema_version" in row.asDict()) == ("evt-1", 3, False)


def test_load_counts_duplicates_and_is_idempotent(spark, paths, deliver):
    deliver(orders(1, 2), T0)
    deliver(orders(2, 3), T0 + timedelta(minutes=5))
    first = run_load(spark, paths, normal(spark, paths), "load-1", T0)
    assert (first.files_discovered, first.files_skipped, first.files_loaded) == (2, 0, 2)
    assert (first.rows_processed, first.rows_inserted, first.duplicates) == (4, 3, 1)
    assert current_watermark(spark, paths) == (date(2026, 8, 19), 12)
    again = run_load(spark, paths, normal(spark, paths), "load-2", T0)
    assert (again.files_discovered, again.files_skipped, again.rows_inserted) == (2, 2, 0)
    # The same run once more replaces what it wrote.
    retried = run_load(spark, paths, load_window(), "load-1", T0)
    assert (retried.files_loaded, retried.rows_inserted) == (2, 3)
    raw = read_models(spark, paths)["raw_orders"]
    assert raw.count() == raw.select("event_id").distinct().count() == 3


def test_load_without_a_lake_finds_nothing(spark, paths):
    counters = run_load(spark, paths, load_window(), "load-1", T0)
    assert (counters.files_discovered, counters.rows_processed, counters.duplicates) == (0, 0, 0)
    assert current_watermark(spark, paths) is None


def test_first_delivery_wins_in_load_order(spark, paths, deliver):
    deliver(orders(1, quantity=5), T0)
    deliver(orders(1, quantity=9), T0 + timedelta(hours=1))
    run_load(spark, paths, load_window(), "load-1", T0)
    register_models(spark, paths)
    row = spark.sql("SELECT * FROM stg_orders").first()
    assert (row.quantity, float(row.order_value), row.kafka_topic) == (5, 86.25, "orders")
    assert spark.table("stg_orders").columns == S.RAW_ORDERS.fieldNames()


def test_replay_and_backfill(spark, paths, deliver):
    for hour in range(3):
        deliver(orders(hour), T0 + timedelta(hours=hour))
    run_load(spark, paths, normal(spark, paths), "load-1", T0)
    mark = current_watermark(spark, paths)
    # A file for an old hour arrives late: a normal load passes it by, a backfill finds it.
    deliver(orders("late"), T0)
    assert run_load(spark, paths, normal(spark, paths), "load-2", T0).rows_inserted == 0
    window = ("2026-08-19T12", "2026-08-19T13")
    filled = run_load(spark, paths, load_window("BACKFILL", start=window[0], end=window[1]), "load-3", T0)
    assert (filled.files_discovered, filled.files_skipped, filled.files_loaded, filled.rows_inserted) == (3, 2, 1, 1)
    replayed = run_load(spark, paths, load_window("REPLAY", start=window[0], end=window[1]), "load-4", T0)
    assert (replayed.files_loaded, replayed.rows_processed, replayed.rows_inserted, replayed.duplicates) == (3, 3, 0, 3)
    assert current_watermark(spark, paths) == mark
    ledger = read_table(spark, paths.ledger("loaded_files"), S.LOADED_FILES, "load_id")
    assert ledger.count() == ledger.select("file_path").distinct().count() == 4


def test_many_files_are_joined_as_a_table(spark, paths, deliver, monkeypatch):
    import orderlake.plans.load as load

    deliver(orders(1, 2), T0)
    run_load(spark, paths, normal(spark, paths), "load-1", T0)
    deliver(orders(2, 3), T0 + timedelta(hours=1))
    monkeypatch.setattr(load, "NAMED_FILES", -1)
    counters = run_load(spark, paths, normal(spark, paths), "load-2", T0)
    assert (counters.files_loaded, counters.rows_processed, counters.rows_inserted) == (1, 2, 1)


def test_value_too_large_for_its_column_stops_the_load(spark, paths, deliver):
    deliver(orders(1, unit_price=1e15), T0)
    with pytest.raises(CheckFailed, match="not_null_unit_price"):
        run_load(spark, paths, load_window(), "load-1", T0)
    assert read_models(spark, paths)["raw_orders"].count() == 0


def test_late_event_corrects_its_day(spark, paths, deliver):
    deliver(orders(1, 2, event_timestamp="2026-08-14T09:00:00+00:00"), T0)
    deliver(orders(3), T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0, max_load_age_minutes=10**6)
    assert day(spark, paths, date(2026, 8, 14)) == (2, 6, 103.5, 51.75)
    later = T0 + timedelta(hours=1)
    deliver(orders(4, event_timestamp="2026-08-14T09:00:00+00:00", unit_price=25.0), later)
    result = run_pipeline(spark, paths, normal(spark, paths), "run-2", later, strict=True)
    assert day(spark, paths, date(2026, 8, 14)) == (3, 9, 178.5, 59.5)
    assert result.verdict.first().status == "HEALTHY" and result.notices.count() == 0
    assert counts(spark, paths) == (4, 4, 4)


def test_full_run_ledgers_and_failure(spark, paths, deliver):
    deliver(orders(1, 2), T0)
    ticks = iter(T0 + timedelta(seconds=n) for n in range(1000))
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0, clock=lambda: next(ticks))
    # A load and a fact build without the mart: a check finds out.
    deliver(orders(3), T0 + timedelta(hours=1))
    later = T0 + timedelta(hours=1)
    run_load(spark, paths, normal(spark, paths), "side-load", later)
    refresh_fact(spark, paths, "side-build")
    verdict, transitions = check_health(spark, paths, "check-1", later)
    assert verdict.first().incident_types == ["FACT_GOLD_RECONCILIATION"]
    assert [r.transition for r in transitions.collect()] == ["OPEN"]
    refresh_daily_sales(spark, paths)
    healed, closing = check_health(spark, paths, "check-2", later + timedelta(minutes=10))
    assert healed.first().status == "HEALTHY"
    assert [r.transition for r in closing.collect()] == ["RESOLVE"]
    incidents = read_table(spark, paths.ledger("pipeline_incidents"), S.INCIDENTS, "run_id")
    state = current_state(incidents, "incident_id", "changed_at").collect()
    assert [(r.opened_by_run_id, r.resolved_by_run_id) for r in state] == [("check-1", "check-2")]
    history = metric_history(read_table(spark, paths.ledger("pipeline_metrics"), S.METRICS, "run_id")).collect()
    assert [r.status for r in history] == ["HEALTHY", "DEGRADED", "HEALTHY"]

    with pytest.raises(HealthDegraded):  # nothing was loaded for nine days
        late = later + timedelta(days=9)
        run_pipeline(spark, paths, normal(spark, paths), "run-2", late, clock=lambda: next(ticks))
    runs = {r.run_id: r for r in recent_runs(current_runs(read_runs(spark, paths))).collect()}
    good, bad = runs["run-1"], runs["run-2"]
    assert (good.status, good.dbt_status, good.health_status) == ("SUCCEEDED", "SUCCEEDED", "HEALTHY")
    assert (good.loader_rows_inserted, good.raw_orders) == (2, 2) and good.duration_seconds > 0
    assert (bad.status, bad.error_message) == ("FAILED", "Pipeline failed. Failed tasks: health")


def test_gate_refuses_an_empty_warehouse(spark, paths, deliver):
    deliver(["not json"], T0)
    with pytest.raises(ValueError, match="no rows"):
        run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    assert current_runs(read_runs(spark, paths)).first().error_message == "Pipeline failed. Failed tasks: gate"


def test_models_stop_on_a_shared_order_id(spark, paths, deliver):
    deliver([event(event_id="evt-1"), event(event_id="evt-2")], T0)
    with pytest.raises(CheckFailed, match="one_event_per_key_order_id"):
        run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    assert read_models(spark, paths)["fct_orders"].count() == 0


def test_fact_full_refresh_and_replacing_rows(spark, paths, deliver):
    deliver(orders(1, 2), T0)
    run_load(spark, paths, load_window(), "load-1", T0)
    refresh_fact(spark, paths, "b1")
    # A stale copy of an event that will be loaded next sits in the fact.
    deliver(orders(3), T0 + timedelta(hours=1))
    stale = read_models(spark, paths)["fct_orders"].where("event_id = 'evt-1'").withColumn("event_id", F.lit("evt-3"))
    table = fct_orders(spark, paths)
    table.commit(table.current(), {"b0": table.write(stale, "b0")})
    run_load(spark, paths, load_window(), "load-2", T0 + timedelta(hours=1))
    refresh_fact(spark, paths, "b2")
    fact = read_models(spark, paths)["fct_orders"]
    assert fact.count() == 3 and fact.where("event_id = 'evt-3' and order_id = 'ORD-3'").count() == 1
    refresh_fact(spark, paths, "b3", full_refresh=True)
    assert sorted(r.event_id for r in read_models(spark, paths)["fct_orders"].collect()) == ["evt-1", "evt-2", "evt-3"]


def test_remediation_reaches_the_mart_once(spark, paths, deliver):
    bad = event(
        event_id="ev-mend",
        event_timestamp="2026-08-11T06:20:30.5+00:00",
        order_id="ORD-M1",
        category="books",
        quantity=0,
        unit_price=12.4,
    )
    deliver([*orders(1), bad], T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    requests = spark.createDataFrame([("ev-mend", {"quantity": "2"})], S.REPAIR_REQUESTS)
    dry = run_remediation(spark, paths, requests, "b-1", T0)
    assert dry.first().outcome == "REPAIRED"
    log = lambda: read_table(spark, paths.ledger("event_reprocessing_log"), S.AUDIT, "batch_id")
    assert [(r.action, r.status, r.republished_topic) for r in log().collect()] == [("DRY_RUN", "DRY_RUN", None)]

    messages = []
    for n in (1, 2):  # published twice by mistake
        out = f"{paths.root}/republished-{n}"
        run_remediation(
            spark,
            paths,
            requests,
            f"p-{n}",
            T0 + timedelta(minutes=n),
            publish=True,
            sink={"fmt": "parquet", "options": {"path": out}},
        )
        messages += spark.read.parquet(out).collect()
    assert len(messages) == 2 and record_positions(spark, paths, "none-yet") == 0
    for n, message in ((2, messages[1]), (1, messages[0])):  # the second one arrives first
        later = T0 + timedelta(hours=3 - n)
        deliver([message.value.decode()], later, kafka_at=later, headers=message.headers)
        run_pipeline(spark, paths, normal(spark, paths), f"run-p{n}", later, strict=True)
        assert day(spark, paths, date(2026, 8, 11)) == (1, 2, 24.8, 24.8)
    assert read_quarantine(spark, paths).count() == 1
    assert read_silver(spark, paths).where("event_id = 'ev-mend'").count() == 2
    # Each publish has the position of its own message, and the audit rows stay as they were written.
    assert record_positions(spark, paths, "again") == 0
    where = lambda r: (r.republished_topic, r.republished_partition, r.republished_offset)
    places = {r.batch_id: where(r) for r in read_audit(spark, paths).collect()}
    assert places == {"b-1": (None, None, None), "p-1": ("orders", 0, 3), "p-2": ("orders", 0, 2)}
    assert {where(r) for r in log().collect()} == {(None, None, None), ("orders", None, None)}


def test_failed_publish_is_audited(spark, paths, deliver):
    deliver(orders(1, currency="USD"), T0)
    requests = spark.createDataFrame([("evt-1", {"currency": "GBP"})], S.REPAIR_REQUESTS)
    with pytest.raises(Exception):
        run_remediation(spark, paths, requests, "p-1", T0, publish=True, sink={"fmt": "no_such_format"})
    row = read_table(spark, paths.ledger("event_reprocessing_log"), S.AUDIT, "batch_id").first()
    assert (row.status, row.republished_topic) == ("PUBLISH_FAILED", None) and "no_such_format" in row.error_message


def test_order_id_repair_is_an_overlay(spark, paths, deliver):
    deliver([event(event_id="evt-1"), event(event_id="evt-2"), event(event_id="evt-2")], T0)
    columns = S.ORDER_KEY_MAP
    good = spark.createDataFrame([("evt-2", "ORD-7713", "ORD-7714")], columns)
    wrong = spark.createDataFrame([("evt-2", "ORD-X", "ORD-7714"), ("evt-9", "ORD-9", "ORD-10")], columns)
    report = {r.event_id: r for r in run_order_key_repair(spark, paths, wrong, "r-0", T0).report.collect()}
    assert (report["evt-2"].outcome, report["evt-9"].outcome) == ("UNEXPECTED_ORDER_ID", "NO_MATCH")
    with pytest.raises(ValueError, match="refused"):
        run_order_key_repair(spark, paths, wrong, "r-0", T0, apply=True)
    run_order_key_repair(spark, paths, good, "r-1", T0)  # dry run
    with pytest.raises(CheckFailed):
        run_pipeline(spark, paths, load_window(), "run-0", T0)
    repair = run_order_key_repair(spark, paths, good, "r-1", T0, apply=True)
    assert [r.order_id for r in repair.rows.collect()] == ["ORD-7714"] * 2
    # A repair changes no sink file; loads read through it.
    assert read_silver(spark, paths).where("order_id = 'ORD-7713'").count() == 3
    run_load(spark, paths, load_window(), "run-0", T0)
    raw = read_models(spark, paths)["raw_orders"]
    assert {(r.event_id, r.order_id) for r in raw.collect()} == {("evt-1", "ORD-7713"), ("evt-2", "ORD-7714")}


def test_order_id_repair_reaches_rows_already_loaded(spark, paths, deliver):
    deliver(orders(1, 2), T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    deliver(orders(3, 4), T0 + timedelta(hours=1))
    run_pipeline(spark, paths, normal(spark, paths), "run-2", T0 + timedelta(hours=1))
    tables = [t(spark, paths) for t in (raw_orders, fct_orders, daily_totals)]
    before = [t.current() for t in tables]
    mart = sorted(map(tuple, read_models(spark, paths)["mart_daily_sales"].collect()))
    good = spark.createDataFrame([("evt-3", "ORD-3", "ORD-3B")], S.ORDER_KEY_MAP)
    run_order_key_repair(spark, paths, good, "r-1", T0 + timedelta(hours=2), apply=True)
    after = [t.current() for t in tables]
    models = read_models(spark, paths)
    for name in ("raw_orders", "fct_orders"):
        ids = {(r.event_id, r.order_id) for r in models[name].collect()}
        assert ids == {("evt-1", "ORD-1"), ("evt-2", "ORD-2"), ("evt-3", "ORD-3B"), ("evt-4", "ORD-4")}
    # Only the load and the build that hold the event were written again, and no month of the mart.
    for old, new in zip(before[:2], after[:2], strict=True):
        assert {n for n in new.parts if new.parts[n].folder != old.parts[n].folder} == {"run-2"}
    assert after[2].parts == before[2].parts and after[2].number == before[2].number + 1
    assert sorted(map(tuple, models["mart_daily_sales"].collect())) == mart
    # Nothing is left to do for the repair itself, nor for the next build; health is as before.
    run_order_key_repair(spark, paths, good, "r-1", T0 + timedelta(hours=2), apply=True)
    assert [t.current().number for t in tables[:2]] == [v.number for v in after[:2]]
    result = run_pipeline(spark, paths, normal(spark, paths), "run-3", T0 + timedelta(hours=2), strict=True)
    assert result.verdict.first().status == "HEALTHY"
    assert fct_orders(spark, paths).current().number == after[1].number


def test_a_repair_interrupted_after_raw_is_finished_by_the_next_build(spark, paths, deliver, monkeypatch):
    import orderlake.plans.repairs as repairs

    deliver(orders(1, 2), T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    good = spark.createDataFrame([("evt-2", "ORD-2", "ORD-2B")], S.ORDER_KEY_MAP)
    monkeypatch.setattr(repairs, "fct_orders", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_order_key_repair(spark, paths, good, "r-1", T0, apply=True)
    assert {r.order_id for r in read_models(spark, paths)["fct_orders"].collect()} == {"ORD-1", "ORD-2"}
    run_pipeline(spark, paths, normal(spark, paths), "run-2", T0 + timedelta(hours=1), strict=True)
    assert {r.order_id for r in read_models(spark, paths)["fct_orders"].collect()} == {"ORD-1", "ORD-2B"}
    assert counts(spark, paths) == (2, 2, 2)


def test_a_retry_without_rows_replaces_the_earlier_attempt(spark, paths):
    frame = spark.createDataFrame([(1,), (2,)], "n int")
    read = lambda: read_table(spark, paths.table("t"), frame.schema, "run_id")
    write_run(frame, paths.table("t"), "run_id", "2026-08-19T12:10")
    write_run(frame, paths.table("t"), "run_id", "other")
    assert sorted((r.n, r.run_id) for r in read().collect()) == [
        (1, "2026-08-19T12:10"), (1, "other"), (2, "2026-08-19T12:10"), (2, "other"),
    ]
    write_run(frame.limit(0), paths.table("t"), "run_id", "2026-08-19T12:10")
    assert sorted((r.n, r.run_id) for r in read().collect()) == [(1, "other"), (2, "other")]


def test_deliveries_are_dealt_by_days_in_step_with_the_table(spark):
    rows = spark.sql("SELECT date_add(DATE'1996-01-01', cast(id % 300 AS int)) AS l_shipdate FROM range(3000)")
    for size, tasks in ((0, 4), (40 * sample.BYTES_PER_TASK, 40), (40 * sample.BYTES_PER_TASK + 1, 41)):
        dealt = sample.by_day(rows, size)
        assert dealt.rdd.getNumPartitions() == tasks
        places = dealt.select("l_shipdate", F.spark_partition_id().alias("task")).distinct()
        assert places.count() == 300
