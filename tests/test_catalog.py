"""Every catalog query against its SQL on the smallest tables, and the plans behind them."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlake import schemas as S
from orderlake.operators.routing import build_quarantine, build_silver, judge
from orderlake.operators.windows import list_files, load_window
from orderlake.plans import catalog, stored
from orderlake.plans.catalog import QUERIES as ON_FRAMES
from orderlake.plans.load import rows_of_files
from orderlake.plans.models import newer_than_fact
from orderlake.plans.stored import QUERIES as ON_TABLES
from orderlake.session import stage
from orderlake.sources.tables import read_table, with_metadata_position
from tools.check_oracle import compare_ready

TABLES = os.environ.get("ORDERLAKE_TEST_TABLES", "/root/testdata/sf0.001")
QUERIES = {**ON_FRAMES, **ON_TABLES}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(TABLES)):
        connection.execute(f"create view {file.removesuffix('.parquet')} as select * from '{TABLES}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, TABLES)
    assert not [node for node in FORBIDDEN if node in plan_of(frame)]
    rows = frame.collect()
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows and compare_ready(frame.columns, rows) == compare_ready(columns, result.fetchall())


def test_entry_points(spark):
    assert entry.entry(spark).columns[0] == "event_date"
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_each_payload_is_parsed_once_per_question(spark):
    for route in (build_silver, build_quarantine):
        assert plan_of(route(judge(spark.createDataFrame([(None,) * 8], S.BRONZE)))).count("from_json(") == 2


def test_first_wins_reduces_before_the_shuffle(spark):
    plan = plan_of(QUERIES["raw_first_wins"](spark, TABLES))
    before = plan.split("Exchange hashpartitioning(event_id", 1)[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_windows_prune_folders_and_files(spark, tmp_path):
    path = str(tmp_path / "silver")
    hours = spark.range(48).selectExpr(
        "concat('e', id) AS event_id", "date_add(DATE'2026-08-01', cast(id div 24 AS int)) AS ingestion_date",
        "cast(id % 24 AS int) AS ingestion_hour",
    )
    hours.coalesce(1).write.partitionBy("ingestion_date", "ingestion_hour").parquet(path)
    silver = with_metadata_position(read_table(spark, path, S.SILVER))
    window = load_window("BACKFILL", start="2026-08-01T22", end="2026-08-02T01")
    chosen = silver.where(window.predicate())
    assert chosen.count() == 4
    scan = [line for line in plan_of(chosen).splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(ingestion_date" in scan
    files = list_files(chosen)
    assert files.count() == 4
    one = files.where(F.col("ingestion_hour") == 0)
    rows = rows_of_files(chosen, one, 1)
    assert [r.event_id for r in rows.collect()] == ["e24"]
    assert rows._jdf.queryExecution().executedPlan().toString().count("Join") == 0
    assert "event_id" not in [line for line in plan_of(files).splitlines() if "FileScan" in line][0].split("ReadSchema")[1]


def test_increment_is_filtered_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([], S.RAW_ORDERS).write.parquet(path)
    staged = read_table(spark, path, S.RAW_ORDERS)
    plan = plan_of(newer_than_fact(staged, staged))
    scan = plan.rsplit("FileScan parquet [event_id", 1)[1]
    filters = scan.split("DataFilters: [", 1)[1].split("PartitionFilters", 1)[0]
    assert "loaded_at" in filters and "Subquery" in filters


def test_keys_are_listed_not_searched_for(spark):
    plan = plan_of(judge(spark.createDataFrame([(None,) * 8], S.BRONZE))).lower()
    assert "jsonobjectkeys" in plan.replace("_", "") and "contains(" not in plan and "replace(" not in plan


def test_times_of_messages_take_no_interval(spark):
    assert "INTERVAL" not in plan_of(catalog.DeliveryLog(spark, TABLES).bronze)


def test_daily_metrics_sort_numbers_and_carry_no_folder_names(spark):
    plan = plan_of(catalog._daily_metrics(catalog.DeliveryLog(spark, TABLES)))
    assert "ingestion_hour=" not in plan and "xxhash64(" in plan


def test_applied_order_key_repair_judges_its_messages_once(spark, monkeypatch):
    judged = []

    def spy(rows, name):
        judged.append("from_json(" in plan_of(rows))
        return stage(rows, name)

    for module in (catalog, stored):
        monkeypatch.setattr(module, "stage", spy)
    stored.QUERIES["applied_order_key_repair"](spark, TABLES)
    assert sum(judged) == 1
