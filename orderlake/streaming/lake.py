"""The streaming jobs: topic to Bronze, Silver and Quarantine, and the console tail.

No watermark and no stream deduplication: late events are kept and correct their
old business date, duplicate deliveries are kept and removed at load.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from orderlake import schemas as S
from orderlake.operators.routing import build_bronze, build_quarantine, build_silver, decode_tail, judge
from orderlake.sources import files
from orderlake.sources.tables import Paths, last_commit

LAYER_PARTITIONS = {
    "bronze": ["ingestion_date"],
    "silver": ["ingestion_date", "ingestion_hour"],
    "quarantine": [],
}


def lake_frames(messages: DataFrame, ingested_at: Column | None = None) -> dict[str, DataFrame]:
    """The three layers of a batch or a stream of messages."""
    bronze = build_bronze(messages, ingested_at)
    judged = judge(bronze)
    return {"bronze": bronze, "silver": build_silver(judged), "quarantine": build_quarantine(judged)}


def _triggered(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    return writer.trigger(**trigger) if trigger else writer


def start_lake(
    messages: DataFrame,
    paths: Paths,
    trigger: dict | None = None,
    ingested_at: Column | None = None,
) -> list[StreamingQuery]:
    """Three independent append queries, each with its own checkpoint and commit log."""
    queries = []
    for layer, frame in lake_frames(messages, ingested_at).items():
        writer = frame.writeStream.format("parquet").outputMode("append").queryName(f"{layer}_orders")
        if LAYER_PARTITIONS[layer]:
            writer = writer.partitionBy(*LAYER_PARTITIONS[layer])
        writer = writer.option("checkpointLocation", paths.checkpoint(f"{layer}_orders"))
        queries.append(_triggered(writer, trigger).start(paths.lake(layer)))
    return queries


def start_lake_single_pass(
    messages: DataFrame, paths: Paths, trigger: dict | None = None, ingested_at: Column | None = None
) -> StreamingQuery:
    """One query that reads and parses the topic once and writes all three layers.

    Each micro-batch owns a ``batch_id`` folder per layer and overwrites it when it
    is run again, so a batch interrupted half way is written exactly once. One
    ingest time holds for the whole batch. The judged messages are staged as a table:
    a cached part would sit in its task's memory, on its way to disk and back too. When
    all three layers are written the batch is noted as committed; readers take committed
    batches only, so no layer shows a batch before the others do.
    """
    spark = messages.sparkSession
    files.put_new(spark, f"{paths.lake_commits()}/started", "")

    def write_layers(batch: DataFrame, batch_id: int) -> None:
        last = last_commit(spark, paths)
        if last is not None and last >= batch_id:
            return  # committed before the stream itself noted it; readers may be at it
        stamp = F.lit(datetime.now(timezone.utc)) if ingested_at is None else ingested_at
        opened = judge(build_bronze(batch, stamp)).drop("unreadable", "first_missing", "event_time_text")

        def writer_of(frame: DataFrame) -> DataFrameWriter:
            return frame.write.mode("overwrite").option("partitionOverwriteMode", "static")

        def write(layer: str, frame: DataFrame) -> None:
            # Tasks put their files in place themselves: nobody reads the batch before it is noted, and a second
            # attempt overwrites it, so the job need not move every file once more.
            writer = writer_of(frame).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            if LAYER_PARTITIONS[layer]:
                writer = writer.partitionBy(*LAYER_PARTITIONS[layer])
            writer.parquet(f"{paths.lake(layer)}/batch_id={batch_id}")

        try:
            writer_of(opened).parquet(paths.judged_batch())
            # Vectored reads keep direct buffers as large as a row group's longest column, one for each reading thread.
            reader = batch.sparkSession.read.schema(opened.schema).option("parquet.hadoop.vectored.io.enabled", "false")
            judged = reader.parquet(paths.judged_batch())
            kept = [*S.BRONZE.fieldNames(), *(c for c in ("reprocessing_id",) if c in judged.columns)]
            bronze = judged.withColumn("ingestion_date", F.to_date("kafka_timestamp")).select(*kept)
            layers = {"bronze": bronze, "silver": build_silver(judged), "quarantine": build_quarantine(judged)}
            with ThreadPoolExecutor(len(layers)) as pool:  # three jobs at once
                list(pool.map(write, layers, layers.values()))
        finally:
            files.remove(spark, paths.judged_batch())
        files.put_new(spark, f"{paths.lake_commits()}/{batch_id:012d}", "")
        files.remove(spark, f"{paths.lake_commits()}/{batch_id - 2:012d}")  # the newest says all

    writer = messages.writeStream.foreachBatch(write_layers).queryName("lake_orders")
    writer = writer.option("checkpointLocation", paths.checkpoint("lake_orders"))
    return _triggered(writer, trigger).start()


def start_tail(messages: DataFrame, sink: str = "console", name: str = "order_tail") -> StreamingQuery:
    """Print (or keep in memory) the decoded messages as they come."""
    writer = decode_tail(messages).writeStream.format(sink).outputMode("append").queryName(name)
    return writer.option("truncate", False).start() if sink == "console" else writer.start()
