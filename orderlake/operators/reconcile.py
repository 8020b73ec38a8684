"""Counts that must agree between the layers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.session import stage

_MESSAGE_KEY = ("topic", "partition", "offset")


def error_summary(judged: DataFrame) -> DataFrame:
    """Messages per error code; both codes NULL counts the accepted ones."""
    return judged.groupBy("contract_error", "validation_error").agg(F.count("*").alias("rows"))


def route_check(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Silver and Quarantine together hold every Bronze message, each exactly once.

    One aggregation over the tagged union of the message keys replaces two joins;
    keys are combined before the shuffle.
    """
    tagged = None
    for layer, frame in (("bronze", bronze), ("silver", silver), ("quarantine", quarantine)):
        counts = [F.lit(int(layer == name)).alias(name) for name in ("bronze", "silver", "quarantine")]
        part = frame.select(*_MESSAGE_KEY, *counts)
        tagged = part if tagged is None else tagged.unionByName(part)
    per_message = tagged.groupBy(*_MESSAGE_KEY).agg(
        *[F.sum(name).alias(name) for name in ("bronze", "silver", "quarantine")]
    )
    routed = F.col("silver") + F.col("quarantine")
    return per_message.agg(
        F.coalesce(F.sum("bronze"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum("silver"), F.lit(0)).alias("silver_rows"),
        F.coalesce(F.sum("quarantine"), F.lit(0)).alias("quarantine_rows"),
        F.count_if(routed < F.col("bronze")).alias("unrouted_messages"),
        F.count_if(routed > F.col("bronze")).alias("surplus_messages"),
        F.count_if((F.col("silver") > 0) & (F.col("quarantine") > 0) & (F.col("bronze") == 1)).alias(
            "doubly_routed_messages"
        ),
    )


# Offsets handled together: runs are cut at multiples of it, so that one busy partition is many groups.
BLOCK = 1 << 22


def offset_runs(layer: DataFrame) -> DataFrame:
    """Messages of a layer folded, in the tasks that read them, to runs of offsets: first, last and how many rows.

    Within a task rows are put in the order of their offsets and numbered: offset less number stays the same while the
    offsets go up by one, and such rows are one group of an ordinary aggregate, combined before the shuffle. A group is a
    run if it has as many rows as offsets from its first to its last (repeated offsets together with gaps can make one
    that is not).
    """
    sorted_rows = layer.select("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
    numbered = sorted_rows.select(
        "topic",
        "partition",
        "offset",
        F.floor(F.col("offset") / BLOCK).alias("block"),
        (F.col("offset") - F.monotonically_increasing_id()).alias("run"),
    )
    return numbered.groupBy("topic", "partition", "block", "run").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("rows")
    ).drop("run")


_PLACE = ("topic", "partition", "block")
_LAYERS = ("bronze", "silver", "quarantine")


def _verdict(counted: DataFrame) -> DataFrame:
    """Route counters from rows of (bronze, silver, quarantine, n): how often each of n offsets is in each layer."""
    routed = F.col("silver") + F.col("quarantine")
    both = (F.col("silver") > 0) & (F.col("quarantine") > 0) & (F.col("bronze") == 1)
    total = lambda amount: F.coalesce(F.sum(amount), F.lit(0))
    return counted.agg(
        *[total(F.col(layer) * F.col("n")).alias(f"{layer}_rows") for layer in _LAYERS],
        total(F.when(routed < F.col("bronze"), F.col("n"))).alias("unrouted_messages"),
        total(F.when(routed > F.col("bronze"), F.col("n"))).alias("surplus_messages"),
        total(F.when(both, F.col("n"))).alias("doubly_routed_messages"),
    )


def route_check_by_runs(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """``route_check`` on runs of offsets: what is shuffled grows with the runs of the layers, not with their messages.

    The ends of all runs of a block, in order, cut it into stretches over which every layer holds each offset equally
    often. Blocks with a group that is no run are counted message by message.
    """
    layers = dict(zip(_LAYERS, (bronze, silver, quarantine), strict=True))
    runs = None
    for name, frame in layers.items():
        part = offset_runs(frame).withColumn("layer", F.lit(name))
        runs = part if runs is None else runs.unionByName(part)
    # Written: the runs are read several times, and each time all layers would be sorted again.
    runs = stage(runs.where("first IS NOT NULL"), f"runs-{uuid.uuid4().hex}")
    mixed = runs.where("rows <> last - first + 1").select(*_PLACE).distinct()
    clean = runs.join(mixed, list(_PLACE), "left_anti")
    opened = [F.when(F.col("layer") == name, 1).otherwise(0).alias(name) for name in _LAYERS]
    closed = [F.when(F.col("layer") == name, -1).otherwise(0).alias(name) for name in _LAYERS]
    both_ends = F.array(
        F.struct(F.col("first").alias("at"), *opened), F.struct((F.col("last") + 1).alias("at"), *closed)
    )
    ends = clean.select(*_PLACE, F.inline(both_ends))
    ends = ends.groupBy(*_PLACE, "at").agg(*[F.sum(name).alias(name) for name in _LAYERS])
    by_place = Window.partitionBy(*_PLACE).orderBy("at")
    stretches = ends.select(
        *[F.sum(name).over(by_place).alias(name) for name in _LAYERS],
        (F.lead("at").over(by_place) - F.col("at")).alias("n"),
    ).where("n IS NOT NULL")

    tagged = None
    for name, frame in layers.items():
        keys = frame.select("topic", "partition", "offset", F.floor(F.col("offset") / BLOCK).alias("block"))
        part = keys.join(mixed, list(_PLACE), "left_semi").select(
            "topic", "partition", "offset", *[F.lit(int(other == name)).alias(other) for other in _LAYERS]
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    messages = tagged.groupBy(*_MESSAGE_KEY).agg(*[F.sum(name).alias(name) for name in _LAYERS])
    return _verdict(stretches.unionByName(messages.select(*_LAYERS, F.lit(1).cast("bigint").alias("n"))))


def offset_ranges(layer: DataFrame) -> DataFrame:
    """Lowest and highest offset and row count per topic partition."""
    ranges = layer.groupBy("partition").agg(
        F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.count("*").alias("rows")
    )
    return ranges.withColumn("missing_offsets", F.col("max_offset") - F.col("min_offset") + 1 - F.col("rows"))


def compare_cases(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """Expected against actual by case; a case missing on either side is a mismatch."""
    joined = expected.select(key, F.col(value).alias("expected"), F.lit(True).alias("_e")).join(
        actual.select(key, F.col(value).alias("actual"), F.lit(True).alias("_a")), key, "full_outer"
    )
    both = F.col("_e").isNotNull() & F.col("_a").isNotNull()
    return joined.select(
        key, "expected", "actual", (both & F.col("expected").eqNullSafe(F.col("actual"))).alias("matches")
    )
