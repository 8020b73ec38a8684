"""One session for all tests, and fixtures that judge and deliver order events."""

from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.operators.routing import judge
from orderlake.session import build_session
from orderlake.sources.tables import Paths
from orderlake.sources.topic import read_orders_stream
from orderlake.streaming.lake import start_lake


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def paths(tmp_path) -> Paths:
    return Paths(str(tmp_path / "lakehouse"))


@pytest.fixture
def judge_payloads(spark):
    """Error codes of payloads, in the order given."""

    def run(payloads, strict: bool = False):
        rows = [(None, p, "orders", 0, i, None, None) for i, p in enumerate(payloads)]
        bronze = spark.createDataFrame(
            rows,
            "kafka_key string, raw_payload string, topic string, partition int, offset bigint, "
            "kafka_timestamp timestamp, ingested_at timestamp",
        )
        judged = judge(bronze, strict).orderBy("offset").collect()
        return [(r.contract_error, r.validation_error) for r in judged]

    return run


@pytest.fixture
def deliver(spark, paths, tmp_path):
    """Put payloads on the topic and let the three streams take them in at a given time."""
    topic = str(tmp_path / "topic")
    state = {"offset": 0}

    def run(payloads, at: datetime, kafka_at: datetime | None = None, headers=None):
        kafka_at = kafka_at or at - timedelta(minutes=1)
        rows = []
        for payload in payloads:
            rows.append((b"key", payload.encode(), S.TOPIC, 0, state["offset"], kafka_at, headers))
            state["offset"] += 1
        spark.createDataFrame(rows, S.HEADED_MESSAGE).coalesce(1).write.mode("append").parquet(topic)
        stream = read_orders_stream(spark, "parquet", path=topic)
        for query in start_lake(stream, paths, {"availableNow": True}, F.lit(at)):
            query.awaitTermination()

    run.topic = topic
    return run
