"""Keeping the stored tables small: many small parts become one, and what no version names goes."""

from __future__ import annotations

from pyspark.sql import SparkSession

from orderlake.sources.tables import Paths, daily_totals, fct_orders, raw_orders
from orderlake.sources.versions import _DAY_MS


def compact_warehouse(
    spark: SparkSession, paths: Paths, name: str, versions: int = 2, older_than_ms: int = _DAY_MS
) -> dict[str, int]:
    """Put the loads of raw orders together into one part, and the builds of the fact; folders read from before.

    Rows and what they cover stay the same, so the next build finds nothing new. A load put together with others can not
    be run again under its name: its events are present. The fact is put together only once all of raw is in it.
    """
    read = {}
    for table in (raw_orders(spark, paths), fct_orders(spark, paths)):
        version = table.current()
        read[table.path] = len(version.parts)
        if len(version.parts) > 1:
            table.compact(name)
    for table in (raw_orders(spark, paths), fct_orders(spark, paths), daily_totals(spark, paths)):
        table.vacuum(versions, older_than_ms)
    return read
