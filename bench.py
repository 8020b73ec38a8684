"""Time the headline queries and one whole pipeline; print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlake.operators.windows import load_window
from orderlake.plans.catalog import QUERIES
from orderlake.plans.load import run_load
from orderlake.plans.models import refresh_daily_sales, refresh_fact
from orderlake.plans.pipeline import check_health, read_models
from orderlake.session import build_session, scratch_root
from orderlake.sources import sample
from orderlake.sources.tables import Paths, read_bronze
from orderlake.streaming.lake import start_lake, start_lake_single_pass

HEADLINE = (
    "silver_orders",
    "quarantine_orders",
    "error_summary",
    "route_reconciliation",
    "raw_first_wins",
    "load_normal",
    "fct_orders_incremental",
    "mart_daily_sales",
    "data_test_report",
    "lake_metrics",
    "health_verdict",
    "incident_transitions",
    "run_state",
    "quarantine_remediation",
    "order_key_overlay",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    # The table is one row group; a real one comes in as many splits as there are cores.
    spread = f"{scratch_root(spark)}/bench-tables-{uuid.uuid4().hex}"
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(int(cpus)).write.parquet(f"{spread}/lineitem.parquet")

    def write_away(name: str):
        return lambda: QUERIES[name](spark, spread).write.format("noop").mode("overwrite").save()

    for name in ("silver_orders", "quarantine_orders"):  # not counted: JVM start-up and compilation
        write_away(name)()
    for name in HEADLINE:
        seconds[name] = timed(write_away(name))

    # The stages of a real run, on files: topic -> lake -> raw -> models -> health.
    root = f"{scratch_root(spark)}/bench-{uuid.uuid4().hex}"
    paths, single = Paths(f"{root}/three"), Paths(f"{root}/single")
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    now = datetime.now(timezone.utc)

    def topic():
        source = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
        return sample.messages(source.repartition(int(cpus), "l_shipdate"))

    def stream() -> None:
        for query in start_lake(topic(), paths, {"availableNow": True}, sample.ingest_time()):
            query.awaitTermination()

    def stream_single_pass() -> None:
        start_lake_single_pass(topic(), single, {"availableNow": True}, sample.ingest_time()).awaitTermination()

    def models() -> None:
        refresh_fact(spark, paths, "bench")
        refresh_daily_sales(spark, paths)

    counters = {}
    seconds["stage_stream_to_lake"] = timed(stream)
    seconds["stage_stream_single_pass"] = timed(stream_single_pass)
    seconds["stage_load"] = timed(
        lambda: counters.update(load=run_load(spark, paths, load_window(), "bench", now))
    )
    seconds["stage_models"] = timed(models)
    seconds["stage_health"] = timed(lambda: check_health(spark, paths, "bench", now, strict=True))

    messages = read_bronze(spark, paths).count()
    load = counters["load"]
    report = {
        "metric": "headline queries and pipeline stages, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "messages": messages,
        "rows_per_sec": {
            "stream_to_lake": round(messages / seconds["stage_stream_to_lake"]),
            "stream_single_pass": round(messages / seconds["stage_stream_single_pass"]),
            "load": round(load.rows_processed / seconds["stage_load"]),
            "models": round(load.rows_inserted / seconds["stage_models"]),
        },
        "raw_orders": read_models(spark, paths)["raw_orders"].count(),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
