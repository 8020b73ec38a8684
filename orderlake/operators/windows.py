"""Which Silver partitions and files a load reads."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORMAL, BACKFILL, REPLAY = "NORMAL", "BACKFILL", "REPLAY"

Partition = tuple[date, int]


def parse_partition(value: str) -> Partition:
    """``YYYY-MM-DDTHH`` to a date and an hour."""
    match = re.fullmatch(r"(\d{4}-\d{2}-\d{2})T([01]\d|2[0-3])", value, flags=re.ASCII)
    if match is None:
        raise ValueError("partition must use YYYY-MM-DDTHH format")
    return date.fromisoformat(match[1]), int(match[2])


def _at_or_after(bound: Partition) -> Column:
    # The bare date comparison is implied; it lets Spark prune date folders.
    day, hour = F.lit(bound[0]), bound[1]
    on, at = F.col("ingestion_date"), F.col("ingestion_hour")
    return (on >= day) & ((on > day) | (at >= hour))


def _at_or_before(bound: Partition) -> Column:
    day, hour = F.lit(bound[0]), bound[1]
    on, at = F.col("ingestion_date"), F.col("ingestion_hour")
    return (on <= day) & ((on < day) | (at <= hour))


@dataclass(frozen=True)
class LoadWindow:
    """NORMAL rescans from the watermark hour on; BACKFILL and REPLAY read a closed range.

    Only REPLAY reads files again that were loaded before, only NORMAL moves the
    watermark.
    """

    mode: str
    start: Partition | None = None
    end: Partition | None = None

    def predicate(self) -> Column:
        """Filter on the two partition columns, pruned by Spark before any file is opened."""
        chosen = F.lit(True)
        if self.start is not None:
            chosen = chosen & _at_or_after(self.start)
        if self.end is not None:
            chosen = chosen & _at_or_before(self.end)
        return chosen

    @property
    def rereads_loaded_files(self) -> bool:
        return self.mode == REPLAY

    @property
    def advances_watermark(self) -> bool:
        return self.mode == NORMAL


def load_window(
    mode: str = NORMAL,
    watermark: Partition | None = None,
    start: str | Partition | None = None,
    end: str | Partition | None = None,
) -> LoadWindow:
    """Check the arguments of a load and say what it reads."""
    first, last = (parse_partition(p) if isinstance(p, str) else p for p in (start, end))
    if mode not in (NORMAL, BACKFILL, REPLAY):
        raise ValueError(f"unknown load mode {mode!r}")
    if (first is None) != (last is None):
        raise ValueError("start and end must be given together")
    if first is not None and first > last:
        raise ValueError("start must not be later than end")
    if mode == NORMAL and first is not None:
        raise ValueError("a normal load takes no range")
    if mode == NORMAL:
        return LoadWindow(NORMAL, start=watermark)
    if first is None:
        raise ValueError(f"{mode.lower()} needs start and end")
    return LoadWindow(mode, start=first, end=last)


def list_files(silver: DataFrame) -> DataFrame:
    """Files of a Silver frame with file positions, and how many rows each holds.

    Reads no data column: the counts come from the file footers' row numbers.
    """
    return silver.groupBy("file_path", "ingestion_date", "ingestion_hour").agg(F.count("*").alias("row_count"))


def select_files(files: DataFrame, window: LoadWindow, ledger: DataFrame) -> DataFrame:
    """The listed files with ``selected``: not loaded yet, or wanted again.

    The ledger grows with the lake, so it is cut to the window first.
    """
    loaded = ledger.where(window.predicate()).select("file_path", F.lit(True).alias("_loaded")).distinct()
    marked = files.where(window.predicate()).join(loaded, "file_path", "left")
    wanted = F.lit(True) if window.rereads_loaded_files else F.col("_loaded").isNull()
    return marked.select(
        *files.columns, F.col("_loaded").isNotNull().alias("loaded_before"), wanted.alias("selected")
    )
