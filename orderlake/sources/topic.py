"""The order topic: streaming source, tail source, republish sink.

``fmt="kafka"`` needs the Kafka connector on the class path. Any other format is
read as files holding messages in the topic's shape (``schemas.MESSAGE``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S

REPAIR_HEADER = "reprocessing_id"


def read_orders_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    from_latest: bool = False,
) -> DataFrame:
    """Messages of the topic, from the earliest offset or only the newest."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        settings = {"subscribe": S.TOPIC, "startingOffsets": "latest" if from_latest else "earliest"}
        reader = reader.options(**{"includeHeaders": "true", **settings, **(options or {})})
        return reader.load().select(*S.HEADED_MESSAGE.fieldNames())
    return reader.schema(S.HEADED_MESSAGE).options(**(options or {})).load(path)


def to_messages(repaired: DataFrame, repair: Column, *others: str) -> DataFrame:
    """Repaired payloads as messages keyed by their order, each with the id of its repair in a header.

    ``others``: further columns of a message that ``repaired`` has.
    """
    header = F.struct(F.lit(REPAIR_HEADER).alias("key"), repair.cast("binary").alias("value"))
    return repaired.select(
        F.col("repaired_order_id").cast("binary").alias("key"),
        F.col("repaired_payload").cast("binary").alias("value"),
        F.lit(S.TOPIC).alias("topic"),
        F.array(header).alias("headers"),
        *others,
    )


def repair_of_message() -> Column:
    """The repair that a message was sent by, from its headers; NULL for other messages."""
    mine = F.filter("headers", lambda h: h["key"] == REPAIR_HEADER)
    return F.try_element_at(mine, F.lit(1))["value"].cast("string")


def publish(messages: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None) -> None:
    """Append messages to the topic."""
    messages.write.format(fmt).mode("append").options(**(options or {})).save()
