"""One row per event: first delivery wins, insert if absent, keyed upsert, current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake import schemas as S

# Load order of the lake: directory, file name, position in the file.
LOAD_ORDER = ("ingestion_date", "ingestion_hour", "file_path", "row_index")

_RENAMED = {"topic": "kafka_topic", "partition": "kafka_partition", "offset": "kafka_offset"}
_MONEY = {"unit_price": S.MONEY_PRICE, "order_value": S.MONEY_VALUE}


def _warehouse_column(field: str) -> str:
    if field in _MONEY:
        return f"try_cast({field} AS {_MONEY[field].simpleString()}) AS {field}"
    return f"`{field}` AS {_RENAMED.get(field, field)}"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key.

    Spark keeps one row per key in every map task before the shuffle (the partial
    window group limit), so a key holding a third of all rows sends one row per
    task, not its rows.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def first_deliveries(silver: DataFrame, order: Sequence[str | Column] = LOAD_ORDER) -> DataFrame:
    return first_per_key(silver, ["event_id"], order)


def to_warehouse_row(silver: DataFrame, *extra: str) -> DataFrame:
    """Silver columns under their warehouse names and money types (NULL if a value does not fit)."""
    fields = [f for f in S.SILVER.fieldNames() if f not in ("ingestion_date", "ingestion_hour")]
    return silver.selectExpr(*[_warehouse_column(f) for f in fields], *extra)


def insert_absent(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose event the target does not hold yet.

    The target's keys are first cut down to the batch's: a batch that Spark knows to be
    small is broadcast for that and nothing of the target is shuffled; else both sides
    shuffle on the key, the target with that one column.
    """
    known = target.select("event_id").join(batch.select("event_id"), "event_id", "left_semi")
    return batch.join(known, "event_id", "left_anti")


def upsert(existing: DataFrame, new: DataFrame, key: str = "event_id") -> DataFrame:
    """``existing`` with the rows of ``new`` put in or in place of theirs."""
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def current_state(ledger: DataFrame, key: str | Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """Newest row per key of an append-only ledger."""
    keys = [key] if isinstance(key, str) else list(key)
    versions = [version] if isinstance(version, str) else list(version)
    return first_per_key(ledger, keys, [F.col(v).desc_nulls_last() for v in versions])
