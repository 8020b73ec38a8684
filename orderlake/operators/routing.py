"""Messages -> Bronze -> parsed and judged events -> Silver or Quarantine.

Every function takes a batch or a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.functions.rules import (
    EVENT_COLUMNS,
    contract_rules,
    first_failure,
    opened_payload,
    quality_rules,
)
from orderlake.sources.topic import repair_of_message

_TRANSPORT = ("kafka_key", "topic", "partition", "offset", "kafka_timestamp", "ingested_at", "raw_payload")


def build_bronze(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Every message untouched, stamped with the ingest time; dated by the broker's clock."""
    stamped = messages.withColumn("ingested_at", F.current_timestamp() if ingested_at is None else ingested_at)
    # Only a topic read with its headers says which repair sent a message.
    repair = [repair_of_message().alias("reprocessing_id")] if "headers" in messages.columns else []
    return stamped.select(*[F.expr(e) for e in (
        "cast(key AS string) AS kafka_key",
        "cast(value AS string) AS raw_payload",
        "topic",
        "`partition`",
        "`offset`",
        "timestamp AS kafka_timestamp",
        "ingested_at",
        "to_date(timestamp) AS ingestion_date",
    )], *repair)


def parse_orders(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Open each payload: readable or not, first missing key, typed event.

    The parses sit in a generator. As plain columns the optimizer would copy them
    into every filter and rule that reads a field (about twenty parses per message);
    it pushes no filter through a generator, so each parse runs once per message.
    """
    transport = [*_TRANSPORT, *(c for c in ("reprocessing_id",) if c in bronze.columns)]
    opened = bronze.select(*transport, F.inline(F.expr(opened_payload("raw_payload", tokens=strict))))
    kept = [*[f"`{name}`" for name in transport], "keys.unreadable", "keys.first_missing", *(["tokens"] if strict else [])]
    return opened.selectExpr(*kept, *EVENT_COLUMNS)


def add_contract_error(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("contract_error", first_failure(contract_rules()))


def add_quality_error(contracted: DataFrame, strict: bool = False) -> DataFrame:
    """Judged only where the contract held."""
    failure = first_failure(quality_rules(strict))
    return contracted.withColumn("validation_error", F.when(F.col("contract_error").isNull(), failure))


def judge(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Bronze to judged events, both error columns set or NULL."""
    return add_quality_error(add_contract_error(parse_orders(bronze, strict)), strict)


def build_silver(judged: DataFrame) -> DataFrame:
    """Accepted events with their derived columns; dated by the ingest clock."""
    return judged.where("contract_error IS NULL AND validation_error IS NULL").selectExpr(
        "event_id",
        "event_type",
        "event_timestamp",
        "to_date(event_timestamp) AS event_date",
        "order_id",
        "customer_id",
        "product_id",
        "category",
        "quantity",
        "unit_price",
        "round(quantity * unit_price, 2) AS order_value",
        "currency",
        "kafka_key",
        "topic",
        "`partition`",
        "`offset`",
        "kafka_timestamp",
        "ingested_at",
        "to_date(ingested_at) AS ingestion_date",
        "lpad(hour(ingested_at), 2, '0') AS ingestion_hour",
    )


def build_quarantine(judged: DataFrame) -> DataFrame:
    """Refused messages with the first failing code."""
    refused = judged.where("contract_error IS NOT NULL OR validation_error IS NOT NULL")
    return refused.select(*S.QUARANTINE.fieldNames())


def decode_tail(messages: DataFrame) -> DataFrame:
    """Plain decode of the newest messages, no validation."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(F.from_json(F.col("value").cast("string"), S.TAIL_EVENT))),
    )
