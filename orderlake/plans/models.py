"""Warehouse models: staging view, incremental fact, daily mart kept up by affected days."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.functions.scalars import mean_money
from orderlake.operators.delivery import upsert
from orderlake.session import stage, unstage
from orderlake.sources.tables import Paths, daily_totals, fct_orders, raw_orders
from orderlake.sources.versions import Part, Snapshot

# Before any load: where an empty fact starts reading.
BEGINNING = datetime(1900, 1, 1, tzinfo=timezone.utc)


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(*S.RAW_ORDERS.fieldNames())


def fact_rows(staged: DataFrame) -> DataFrame:
    return staged.select(
        "event_id",
        "order_id",
        "customer_id",
        "product_id",
        F.col("event_timestamp").alias("ordered_at"),
        "event_date",
        "category",
        "quantity",
        "unit_price",
        "order_value",
        "currency",
        "loaded_at",
    )


def newer_than_fact(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged rows loaded after the newest row of the fact.

    The high-water mark is a scalar subquery: it runs first and its value becomes a
    filter of the Parquet scan, so files of earlier loads are skipped.
    """
    mark = fact.agg(F.coalesce(F.max("loaded_at"), F.lit(BEGINNING)).alias("mark"))
    return staged.where(F.col("loaded_at") > mark.scalar())


def build_fact(staged: DataFrame, fact: DataFrame | None = None, full_refresh: bool = False) -> DataFrame:
    """The fact after this build: rebuilt, or the given one with the newer rows upserted."""
    if fact is None or full_refresh:
        return fact_rows(staged)
    return upsert(fact, fact_rows(newer_than_fact(staged, fact)))


def daily_sums(fact: DataFrame) -> DataFrame:
    """Sums per business date (``schemas.DAILY_TOTALS``)."""
    return fact.groupBy("event_date").agg(
        F.count("*").alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        F.count("quantity").alias("with_units"),
        F.sum("order_value").alias("total"),
        # Like avg: a value that is NULL counts in order_count, not in the mean.
        F.count("order_value").alias("valued"),
    )


def sales_of_sums(totals: DataFrame) -> DataFrame:
    return totals.select(
        "event_date",
        "order_count",
        "units_sold",
        F.round("total", 2).cast("decimal(24,2)").alias("gross_revenue"),
        F.when(F.col("valued") > 0, mean_money(F.col("total"), F.col("valued"))).alias("average_order_value"),
    )


def build_daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per business date over the whole fact, so late events correct old dates."""
    return sales_of_sums(daily_sums(fact))


def signed_sums(added: DataFrame, removed: DataFrame) -> DataFrame:
    """What rows put in and rows taken out change in the sums of their days; days that stay as they are are left out."""
    more, less = daily_sums(added), daily_sums(removed)
    names = [c for c in more.columns if c != "event_date"]
    minus = less.select("event_date", *[(-F.col(c)).alias(c) for c in names])
    net = more.unionByName(minus).groupBy("event_date").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    changed = [F.col(c) != 0 for c in names]
    return net.where(changed[0] | changed[1] | changed[2] | changed[3] | changed[4])


def changed_days(standing: DataFrame, changes: DataFrame) -> DataFrame:
    """Sums with signed changes put on; days without rows go."""
    names = S.DAILY_TOTALS.fieldNames()
    sums = standing.select(*names).unionByName(changes.select(*names)).groupBy("event_date")
    sums = sums.agg(*[F.sum(c).alias(c) for c in names[1:]]).where("order_count > 0")
    return sums.select(
        "event_date",
        "order_count",
        F.when(F.col("with_units") > 0, F.col("units_sold")).alias("units_sold"),
        "with_units",
        F.when(F.col("valued") > 0, F.col("total").cast("decimal(24,2)")).alias("total"),
        "valued",
    )


def unbuilt(source: Snapshot, built: Mapping[str, Part]) -> tuple[list[str], dict[str, Part]]:
    """Parts of ``source`` that have to be read, and the parts built before that stay.

    A part made from a folder that is no longer there goes, and what it was made from is read again; so does one that
    shares a folder with a part to be read.
    """
    present = source.covered()
    kept = {n: p for n, p in built.items() if present.issuperset(p.sources)}
    while True:
        done = {f for p in kept.values() for f in p.sources}
        names = [n for n, p in source.parts.items() if not done.issuperset(p.covers)]
        read = source.covered(names)
        again = [n for n, p in kept.items() if read.intersection(p.sources)]
        if not again:
            return names, kept
        for n in again:
            del kept[n]


def refresh_fact(spark: SparkSession, paths: Paths, build_id: str, full_refresh: bool = False) -> None:
    """Bring the stored fact up to date with one new version of it.

    The parts of raw that the fact was not made from yet become the part of this build, whatever their ``loaded_at``;
    parts made from rows that a repair or a retried load replaced are made again. Events that the fact has already are
    looked for in the buckets of the new rows only, and replaced.
    """
    raw, fact = raw_orders(spark, paths), fct_orders(spark, paths)
    loaded, base = raw.current(), fact.current()
    # A retried build must not see its own earlier attempt.
    built = {} if full_refresh else {n: p for n, p in base.parts.items() if n != build_id}
    names, kept = unbuilt(loaded, built)
    changes: dict[str, Part | None] = dict.fromkeys(set(base.parts) - set(kept))
    if not names and not changes:
        return
    new = raw.read(loaded, names)
    rows = fact_rows(stage_orders(new))
    if kept and names:
        buckets = [r.bucket for r in new.select("bucket").distinct().collect()]  # folder names; no row is read
        held = fact.read(base, kept, buckets).select("event_id", "build_id")
        held = held.join(rows.select("event_id"), "event_id", "left_semi").select("build_id").distinct()
        touched = [r.build_id for r in held.collect()]  # names of builds
        if touched:
            rest = fact.read(base, touched).join(rows.select("event_id"), "event_id", "left_anti")
            changes |= fact.write_parts(rest, touched, {n: kept[n].sources for n in touched})
    changes[build_id] = fact.write(rows, build_id, sorted(loaded.covered(names))) if names else None
    fact.commit(base, changes)


def refresh_daily_sales(spark: SparkSession, paths: Paths) -> None:
    """Bring the stored mart up to date with the fact.

    Rows of builds that came are added to the sums of their days, those of builds that went are taken out; only the
    months of these days are read and written. Without sums to start from, all of the fact is added up.
    """
    fact, mart = fct_orders(spark, paths), daily_totals(spark, paths)
    built, base = fact.current(), mart.current()
    known, present = set(base.notes.get("sources", ())), built.covered()
    added = [n for n, p in built.parts.items() if not known.issuperset(p.covers)]
    gone = known - present
    mixed = any(known.intersection(built.parts[n].covers) for n in added)  # put together from old and new rows
    notes = {"sources": sorted(present)}
    if base.number == 0 or mixed or gone == known or not fact.has_folders(gone):
        totals, replaced = daily_sums(fact.read(built)), list(base.parts)
        months = None
    else:
        changes = stage(signed_sums(fact.read(built, added), fact.read_folders(gone)), f"sums-{built.number}")
        months = [r.month for r in changes.select(_month()).distinct().collect()]  # of business time
        replaced = [m for m in months if m in base.parts]
        totals = changed_days(mart.read(base, replaced), changes)
    totals = totals.select(*S.DAILY_TOTALS.fieldNames(), _month())
    if months is None:
        totals = stage(totals, f"sums-{built.number}")
        months = [r.month for r in totals.select("month").distinct().collect()]
    parts = mart.write_parts(totals, months) if months else {}
    mart.commit(base, {**dict.fromkeys(replaced), **parts}, notes)
    unstage(spark, f"sums-{built.number}")


def _month() -> Column:
    return F.coalesce(F.date_format("event_date", "yyyy-MM"), F.lit("undated")).alias("month")


def daily_sales(spark: SparkSession, paths: Paths) -> DataFrame:
    """The stored mart."""
    return sales_of_sums(daily_totals(spark, paths).read())
