"""Versioned tables, buckets, affected days, kept-up counts and the single-pass lake's commits."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from builders import event, utc
from orderlake import schemas as S
from orderlake.operators.checks import DATA_TESTS, Check, run_checks, run_checks_on_changes
from orderlake.operators.health import due_notices, lake_metrics, with_stamps
from orderlake.operators.reconcile import BLOCK, offset_runs, route_check, route_check_by_runs
from orderlake.operators.windows import load_window
from orderlake.plans.distincts import maintained_lake_metrics, silver_events
from orderlake.plans.load import absent_events, current_watermark, run_load
from orderlake.plans.models import build_daily_sales, daily_sales, refresh_daily_sales, refresh_fact, unbuilt
from orderlake.plans.pipeline import (
    HealthDegraded,
    check_health,
    incident_state,
    mark_sent,
    owed_notices,
    read_models,
    run_pipeline,
)
from orderlake.plans.upkeep import compact_warehouse
from orderlake.session import scratch_root
from orderlake.sources import files
from orderlake.sources.tables import (
    Paths,
    daily_totals,
    fct_orders,
    last_commit,
    raw_orders,
    read_bronze,
    read_quarantine,
    read_silver,
    read_table,
)
from orderlake.sources.topic import read_orders_stream
from orderlake.sources.versions import ConcurrentCommit, Part, Snapshot, VersionedTable
from orderlake.streaming.lake import start_lake_single_pass

T0 = utc(2026, 8, 19, 12, 30)
ROWS = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("n", T.IntegerType())])


def orders(*ids, **changes):
    return [event(event_id=f"evt-{i}", order_id=f"ORD-{i}", **changes) for i in ids]


def normal(spark, paths):
    return load_window(watermark=current_watermark(spark, paths))


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), ROWS, "load_id", bucket_by="event_id", buckets=8)


def some(spark, start, stop):
    return spark.range(start, stop).selectExpr("concat('e', id) AS event_id", "cast(id AS int) AS n")


def numbers(df):
    return sorted(r.n for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def folders_read(df):
    """Bucket folders that the rows of a frame came from, by what the scan opened."""
    df = df.select("*")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    return sum(scans.apply(i).metrics().apply("numPartitions").value() for i in range(scans.size()))


# --- versions -----------------------------------------------------------------


def test_readers_keep_their_version(spark, table):
    assert table.read().count() == 0
    first = table.commit(table.current(), {"a": table.write(some(spark, 0, 10), "a")})
    old = table.read()
    second = table.commit(first, {"a": table.write(some(spark, 5, 7), "a"), "b": table.write(some(spark, 90, 91), "b")})
    assert numbers(old) == numbers(table.read(first)) == list(range(10))
    assert numbers(table.read()) == [5, 6, 90]
    assert {r.load_id for r in table.read(second, ["b"]).collect()} == {"b"}
    table.commit(second, {"a": None})
    assert numbers(table.read()) == [90]


def test_nothing_shows_between_write_and_commit(spark, table):
    base = table.commit(table.current(), {"a": table.write(some(spark, 0, 10), "a")})
    table.write(some(spark, 10, 20), "b")  # the job dies here
    assert numbers(table.read()) == list(range(10))
    table.commit(base, {"b": table.write(some(spark, 10, 20), "b")})  # and runs again
    assert numbers(table.read()) == list(range(20))
    assert len(table.vacuum(older_than_ms=-1000)) == 1  # what the dead job wrote
    assert numbers(table.read()) == list(range(20))


def test_the_second_of_two_writers_is_told(spark, table):
    base = table.current()
    table.commit(base, {"a": table.write(some(spark, 0, 1), "a")})
    with pytest.raises(ConcurrentCommit):
        table.commit(base, {"b": table.write(some(spark, 1, 2), "b")})
    assert numbers(table.read()) == [0]


def test_a_half_written_version_file_is_no_version(spark, table):
    table.commit(table.current(), {"a": table.write(some(spark, 0, 1), "a")})
    hidden = f"{table.path}/versions/.0000000002.json-left"
    assert files.put_new(spark, hidden, '{"parts"') and not files.put_new(spark, hidden, "")
    assert table.current().number == 1


def test_parts_without_rows_and_odd_names(spark, table):
    name = "2026-08-19T12:10 a/b=c%"
    snapshot = table.commit(table.current(), {name: table.write(some(spark, 0, 3), name), "none": table.write(some(spark, 0, 0), "none")})
    assert {r.load_id for r in table.read().collect()} == {name}
    assert table.read(snapshot, ["none"]).count() == 0 and snapshot.covered(["none"]) == set()


def test_buckets_are_folders_that_a_reader_can_name(spark, table):
    snapshot = table.commit(table.current(), {n: table.write(some(spark, 100 * i, 100 * i + 100), n) for i, n in enumerate("ab")})
    three = table.read(snapshot, buckets=[1, 4, 6])
    assert folders_read(three) == 6  # three buckets of each part
    assert 0 < three.count() < 200
    batch = some(spark, 50, 53).withColumn("x", F.lit(1))
    touched = table.buckets_of(batch)
    new = absent_events(table, snapshot, snapshot.parts, batch.unionByName(some(spark, 300, 301).withColumn("x", F.lit(2))))
    assert [r.event_id for r in new.collect()] == ["e300"]
    assert len(touched) <= 3


def test_compaction_keeps_rows_and_what_they_cover(spark, table):
    snapshot = table.current()
    for i in range(4):
        snapshot = table.commit(snapshot, {f"l{i}": table.write(some(spark, 10 * i, 10 * i + 10), f"l{i}")}, {"kept": i})
    merged = table.compact("m", ["l0", "l1", "l2"])
    assert numbers(table.read()) == list(range(40)) and set(merged.parts) == {"m", "l3"}
    assert merged.covered() == snapshot.covered() and merged.notes == {"kept": 3}
    assert {r.load_id for r in table.read().where("n < 30").collect()} == {"m"}


@pytest.mark.parametrize(
    "raw, built, names, kept",
    [
        ({"l1": "A"}, {}, ["l1"], []),
        ({"l1": "A", "l2": "B"}, {"b1": "A"}, ["l2"], ["b1"]),
        ({"l1": "A2", "l2": "B"}, {"b1": "A", "b2": "B"}, ["l1"], ["b2"]),  # load 1 was written again
        ({"l1": "A2", "l2": "B"}, {"b1": "AB"}, ["l1", "l2"], []),
        ({"m": "AB"}, {"b1": "A", "b2": "B"}, [], ["b1", "b2"]),  # compacted
        ({"m": "AB"}, {"b1": "A"}, ["m"], []),  # compacted before all of it was built
    ],
)
def test_what_a_build_has_to_read(raw, built, names, kept):
    cover = lambda text: (text,) if text.startswith("A2") else tuple(text)
    source = Snapshot(1, {n: Part(n, cover(c)) for n, c in raw.items()})
    parts = {n: Part(n, (n,), tuple(c)) for n, c in built.items()}
    got = unbuilt(source, parts)
    assert (sorted(got[0]), sorted(got[1])) == (names, kept)


# --- load, fact and mart -----------------------------------------------------------


def staged_names(spark):
    return [n for n, _ in files.list_names(spark, f"{scratch_root(spark)}/staged")]


def test_runs_leave_nothing_staged(spark, paths, deliver):
    before = staged_names(spark)
    deliver(orders(1, 2), T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    deliver([event(event_id="evt-9", order_id="ORD-1")], T0 + timedelta(hours=1))
    with pytest.raises(Exception, match="one_event_per_key_order_id"):
        run_pipeline(spark, paths, normal(spark, paths), "run-2", T0 + timedelta(hours=1))
    with pytest.raises(Exception, match="one_event_per_key_order_id"):
        run_pipeline(spark, paths, normal(spark, paths), "run-2", T0 + timedelta(hours=1))
    assert staged_names(spark) == before


def test_an_equal_or_older_load_time_still_reaches_the_fact(spark, paths, deliver):
    for n, at in enumerate((T0, T0, T0 - timedelta(hours=5))):
        deliver(orders(n), T0 + timedelta(minutes=n))
        run_load(spark, paths, load_window(), f"l{n}", at)
        refresh_fact(spark, paths, f"b{n}")
    assert read_models(spark, paths)["fct_orders"].count() == 3


def test_a_load_run_again_is_made_again_downstream(spark, paths, deliver):
    deliver(orders(1, 2), T0)
    run_load(spark, paths, load_window(), "l1", T0)
    refresh_fact(spark, paths, "b1")
    refresh_daily_sales(spark, paths)
    deliver(orders(3), T0)
    run_load(spark, paths, load_window(), "l1", T0)  # the same run, which finds more by now
    refresh_fact(spark, paths, "b2")
    refresh_daily_sales(spark, paths)
    models = read_models(spark, paths)
    assert [models[m].count() for m in ("raw_orders", "fct_orders")] == [3, 3]
    assert models["mart_daily_sales"].first().order_count == 3
    assert set(fct_orders(spark, paths).current().parts) == {"b2"}


def test_only_affected_months_of_the_mart_are_written(spark, paths, deliver):
    stamp = "2026-{}-14T09:00:00+00:00"
    for n, month in enumerate(("05", "06", "07")):
        deliver(orders(f"a{n}", f"b{n}", event_timestamp=stamp.format(month)), T0 + timedelta(hours=n))
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    mart = daily_totals(spark, paths)
    before = mart.current()
    deliver(orders("late", event_timestamp=stamp.format("06"), unit_price=2.5), T0 + timedelta(hours=9))
    run_pipeline(spark, paths, normal(spark, paths), "run-2", T0 + timedelta(hours=9))
    after = mart.current()
    assert {m for m in after.parts if after.parts[m] != before.parts.get(m)} == {"2026-06"}
    rebuilt = build_daily_sales(read_models(spark, paths)["fct_orders"])
    assert sorted(map(tuple, daily_sales(spark, paths).collect())) == sorted(map(tuple, rebuilt.collect()))
    # Rows that go are taken out again, and a day without rows goes.
    fact = fct_orders(spark, paths)
    version = fact.current()
    fact.commit(version, {"run-2": None})
    refresh_daily_sales(spark, paths)
    assert sorted(map(tuple, daily_sales(spark, paths).collect())) == sorted(map(tuple, _sales(mart, before)))
    fact.commit(fact.current(), {"run-1": None})
    refresh_daily_sales(spark, paths)
    assert daily_sales(spark, paths).count() == 0


def _sales(mart, snapshot):
    from orderlake.plans.models import sales_of_sums

    return sales_of_sums(mart.read(snapshot)).collect()


def test_a_failed_publish_leaves_the_old_models(spark, paths, deliver, monkeypatch):
    deliver(orders(1, 2), T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    shown = [read_models(spark, paths)[m].count() for m in ("fct_orders", "mart_daily_sales")]
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "commit", lambda *_: 1 / 0)
        for job in (lambda: refresh_fact(spark, paths, "full", full_refresh=True), lambda: refresh_daily_sales(spark, paths)):
            with pytest.raises(ZeroDivisionError):
                job()
    assert [read_models(spark, paths)[m].count() for m in ("fct_orders", "mart_daily_sales")] == shown


def test_compacted_warehouse_holds_the_same_rows(spark, paths, deliver):
    for n in range(3):
        deliver(orders(n, f"x{n}"), T0 + timedelta(hours=n))
        run_pipeline(spark, paths, normal(spark, paths), f"run-{n}", T0 + timedelta(hours=n))
    models = {n: sorted(map(str, df.drop("load_id", "build_id").collect())) for n, df in read_models(spark, paths).items()}
    compact_warehouse(spark, paths, "c1", older_than_ms=-1000)
    assert [len(t(spark, paths).current().parts) for t in (raw_orders, fct_orders)] == [1, 1]
    again = {n: sorted(map(str, df.drop("load_id", "build_id").collect())) for n, df in read_models(spark, paths).items()}
    assert again == models
    deliver(orders("new", 1), T0 + timedelta(hours=5))
    result = run_pipeline(spark, paths, normal(spark, paths), "run-9", T0 + timedelta(hours=5), strict=True)
    assert (result.counters.rows_processed, result.counters.rows_inserted) == (2, 1)
    assert set(fct_orders(spark, paths).current().parts) == {"c1", "run-9"}


# --- tests on changes, counts kept up ---------------------------------------------------


def test_checks_on_changes_find_what_the_whole_finds(spark):
    columns = "event_id string, order_id string, event_type string, currency string, quantity int, product_id string, order_value int"
    old = spark.createDataFrame([(f"e{i}", f"O{i}", "order_created", "GBP", 1, "P", 1) for i in range(50)], columns)
    new = spark.createDataFrame(
        [
            ("e3", "O3", "order_created", "GBP", 1, "P", 1),  # an event again
            ("n1", "O7", "order_created", "GBP", None, None, 1),  # another's order
            ("n2", "ON", "order_gone", "USD", 1, "P", 1),
            ("n2", "ON", "order_gone", "EUR", 1, "P", 1),
        ],
        columns,
    )
    whole = old.unionByName(new)
    for name in ("raw_orders", "stg_orders"):
        rules = DATA_TESTS[name]
        expected = {r.rule: r.failing_rows for r in run_checks({name: whole}, {name: rules}).collect()}
        touched = whole.where(F.col("event_id").isin("e3", "n1", "n2"))
        got = {r.rule: r.failing_rows for r in run_checks_on_changes(name, new, touched, whole, rules).collect()}
        assert got == expected and sum(got.values()) > 2


def test_tests_read_new_rows_and_their_buckets_only(spark, paths, deliver, monkeypatch):
    import orderlake.plans.pipeline as pipeline

    asked = []
    plain = pipeline.run_checks_on_changes
    spy = lambda name, fresh, touched, *rest: asked.append((name, fresh, touched)) or plain(name, fresh, touched, *rest)
    monkeypatch.setattr(pipeline, "run_checks_on_changes", spy)
    deliver(orders(*range(200)), T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    deliver(orders("one", "two"), T0 + timedelta(hours=1))
    asked.clear()
    run_pipeline(spark, paths, normal(spark, paths), "run-2", T0 + timedelta(hours=1))
    assert [name for name, _, _ in asked] == ["raw_orders", "stg_orders", "fct_orders"]
    for _, fresh, touched in asked:
        assert fresh.count() == 2
        buckets = {r.bucket for r in touched.select("bucket").distinct().collect()}
        assert len(buckets) <= 2 and touched.count() < 40


def test_distinct_events_are_kept_up(spark, paths, deliver):
    def both(check_id):
        kept = maintained_lake_metrics(spark, paths, check_id).first().asDict()
        counted = lake_metrics(read_bronze(spark, paths), read_silver(spark, paths), read_quarantine(spark, paths)).first()
        assert kept == counted.asDict()
        return kept["silver_rows"], kept["silver_unique_events"]

    deliver([*orders(1, 2, 2), "not json"], T0)
    assert both("c1") == (3, 2)
    assert both("c1") == both("c2") == (3, 2)  # nothing new: nothing counted again
    number = silver_events(spark, paths).current().number
    assert number == 1
    deliver(orders(2, 3, 3, 4), T0 + timedelta(hours=1))
    assert both("c3") == (7, 4)
    assert silver_events(spark, paths).current().number == 2


def test_a_check_that_died_between_keys_and_files_counts_once(spark, paths, deliver, monkeypatch):
    import orderlake.plans.distincts as distincts

    deliver(orders(1, 2, 2), T0)
    plain = distincts.counted_files

    class Dies(VersionedTable):
        def commit(self, *_):
            raise RuntimeError("lost")

    def dying(spark, paths):
        table = plain(spark, paths)
        return Dies(spark, table.path, table.schema, table.part_column)

    with monkeypatch.context() as broken:
        broken.setattr(distincts, "counted_files", dying)
        with pytest.raises(RuntimeError, match="lost"):
            maintained_lake_metrics(spark, paths, "c1")
    row = maintained_lake_metrics(spark, paths, "c1").first()
    assert (row.silver_rows, row.silver_unique_events) == (3, 2)


# --- routes by runs ----------------------------------------------------------------


def layer(spark, *offsets, partition=0):
    rows = [("orders", partition, o) for o in offsets]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint")


CASES = [
    (range(100), range(0, 100, 2), range(1, 100, 2)),
    (range(100), range(0, 90), range(92, 100)),  # two lost
    (range(10), range(10), [3, 4]),  # twice routed
    (range(10), [0, 1, 1, 2, 3, 4, 4, 7], [5, 6, 8, 9, 50]),  # repeated and unknown messages
    ([5, 5, 7, 8, 8], [5, 5, 7], [8, 8]),  # repeated in Bronze, with a gap behind
    (range(BLOCK - 5, BLOCK + 5), range(BLOCK - 5, BLOCK + 2), range(BLOCK + 3, BLOCK + 5)),  # across blocks
    ([], [1, 2], []),
    ([], [], []),
]


@pytest.mark.parametrize("bronze, silver, quarantine", CASES)
@pytest.mark.parametrize("tasks", [1, 3])
def test_routes_by_runs_equal_routes_by_messages(spark, bronze, silver, quarantine, tasks):
    frames = [layer(spark, *o).unionByName(layer(spark, *o, partition=1)).repartition(tasks) for o in (bronze, silver, quarantine)]
    assert route_check_by_runs(*frames).first() == route_check(*frames).first()


def test_runs_are_folded_where_they_are_read(spark):
    # Rows of a file stand in the order of their offsets; 12 files with 1,000 messages each are 12 groups.
    frame = spark.range(0, 12_000, 1, 12).selectExpr("'orders' AS topic", "0 AS partition", "id AS offset")
    runs = offset_runs(frame)
    assert runs.count() == 12 and runs.agg(F.sum("rows")).first()[0] == 12_000
    assert "Window" not in plan_of(runs)


# --- the single-pass lake ---------------------------------------------------------------


def test_a_half_written_batch_shows_in_no_layer(spark, paths, deliver, monkeypatch):
    import orderlake.streaming.lake as lake

    deliver(["not json", *orders(1, 2)], T0)
    single = Paths(paths.root + "-single")

    def start():
        stream = read_orders_stream(spark, "parquet", path=deliver.topic)
        start_lake_single_pass(stream, single, {"availableNow": True}, F.lit(T0)).awaitTermination()

    layers = lambda: [read(spark, single).count() for read in (read_bronze, read_silver, read_quarantine)]
    start()
    assert layers() == [3, 2, 1] and last_commit(spark, single) == 0
    deliver(orders(3, 4), T0)
    with monkeypatch.context() as broken:
        broken.setattr(lake, "build_quarantine", lambda judged: judged.selectExpr("raise_error('lost') AS raw_payload"))
        with pytest.raises(Exception, match="lost"):
            start()
    assert layers() == [3, 2, 1]  # Bronze and Silver of the second batch are written, but not committed
    start()
    assert layers() == [5, 4, 1] and last_commit(spark, single) == 1


def test_a_batch_is_judged_into_a_table_that_goes_with_it(spark, paths, deliver, monkeypatch):
    import orderlake.streaming.lake as lake

    single, seen, build = Paths(paths.root + "-single"), [], lake.build_quarantine

    def start(quarantine):
        def spied(judged):
            seen.append((judged.storageLevel.useMemory, {f.rsplit("/", 2)[-2] for f in judged.inputFiles()}))
            return quarantine(judged)

        monkeypatch.setattr(lake, "build_quarantine", spied)
        stream = read_orders_stream(spark, "parquet", path=deliver.topic)
        start_lake_single_pass(stream, single, {"availableNow": True}, F.lit(T0)).awaitTermination()

    deliver(["not json", *orders(1, 2)], T0)
    with pytest.raises(Exception, match="lost"):
        start(lambda judged: judged.selectExpr("raise_error('lost') AS raw_payload"))
    assert seen == [(False, {"judged_batch"})] and not files.exists(spark, single.judged_batch())
    start(build)
    assert seen[1:] == [(False, {"judged_batch"})] and not files.exists(spark, single.judged_batch())
    assert [read(spark, single).count() for read in (read_bronze, read_silver, read_quarantine)] == [3, 2, 1]


def test_a_lake_without_a_committed_batch_is_empty(spark, paths, deliver):
    deliver(orders(1), T0)
    files.put_new(spark, f"{paths.lake_commits()}/started", "")
    assert read_silver(spark, paths).count() == 0


# --- notices --------------------------------------------------------------------------


def test_notices_are_owed_until_they_are_sent(spark, paths, deliver):
    deliver(orders(1), T0)
    run_pipeline(spark, paths, normal(spark, paths), "run-1", T0)
    late = T0 + timedelta(days=9)
    for run in ("run-2", "run-3"):  # the alert of the first run could not be sent
        with pytest.raises(HealthDegraded):
            run_pipeline(spark, paths, normal(spark, paths), run, late)
        owed = owed_notices(spark, paths).collect()
        assert [(r.notice, r.incident_type) for r in owed] == [("ALERT", "WAREHOUSE_FRESHNESS")]
    mark_sent(spark, paths, owed_notices(spark, paths), late, "s1")
    assert owed_notices(spark, paths).count() == 0
    assert incident_state(spark, paths).first().alert_sent_at is not None
    verdict, _ = check_health(spark, paths, "run-4", late + timedelta(hours=1), max_load_age_minutes=10**6)
    assert verdict.first().status == "HEALTHY"
    owed = owed_notices(spark, paths)
    assert [r.notice for r in owed.collect()] == ["RECOVERY"]
    mark_sent(spark, paths, owed, late, "s2")
    mark_sent(spark, paths, owed_notices(spark, paths), late, "s3")
    state = incident_state(spark, paths).first()
    assert state.alert_sent_at is not None and state.recovery_sent_at is not None
    assert owed_notices(spark, paths).count() == 0


def test_due_notices_of_many_incidents(spark):
    nothing = (None, None, None, None)
    rows = [(f"i{n}", "T", "DEGRADED", "d", T0, T0 if n % 2 else None, *nothing, "OPEN", T0) for n in range(4)]
    incidents = spark.createDataFrame(rows, S.INCIDENTS)
    stamps = spark.createDataFrame([("i0", "ALERT", T0), ("i1", "ALERT", T0), ("i1", "ALERT", T0 + timedelta(hours=1))], S.NOTICE_STAMPS)
    due = {(r.incident_id, r.notice) for r in due_notices(incidents, stamps).collect()}
    assert due == {("i1", "RECOVERY"), ("i2", "ALERT"), ("i3", "ALERT"), ("i3", "RECOVERY")}
    stamped = {r.incident_id: r.alert_sent_at for r in with_stamps(incidents, stamps).collect()}
    assert stamped["i2"] is None and stamped["i1"] == stamped["i0"]
