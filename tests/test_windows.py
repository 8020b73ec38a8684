"""Load windows and file choice."""

from datetime import date

import pytest

from orderlake.operators.windows import load_window, parse_partition, select_files

PARTITIONS = [(12, 19), (12, 20), (12, 21), (13, 0), (13, 1)]


def frame(spark, partitions):
    rows = [(f"f-{d}-{h}", date(2026, 8, d), h, 1) for d, h in partitions]
    return spark.createDataFrame(rows, "file_path string, ingestion_date date, ingestion_hour int, row_count bigint")


def chosen(spark, window, partitions=PARTITIONS):
    rows = frame(spark, partitions).where(window.predicate()).collect()
    return sorted((r.ingestion_date.day, r.ingestion_hour) for r in rows)


def test_normal_without_watermark_takes_all(spark):
    assert chosen(spark, load_window()) == PARTITIONS
    assert chosen(spark, load_window(), []) == []


def test_normal_rescans_the_watermark_hour(spark):
    window = load_window(watermark=(date(2026, 8, 12), 20))
    assert chosen(spark, window) == [(12, 20), (12, 21), (13, 0), (13, 1)]
    assert window.advances_watermark and not window.rereads_loaded_files


def test_backfill_is_a_closed_range_whatever_the_watermark(spark):
    window = load_window("BACKFILL", watermark=(date(2026, 8, 15), 11), start="2026-08-12T20", end="2026-08-13T00")
    assert chosen(spark, window) == [(12, 20), (12, 21), (13, 0)]
    assert not window.advances_watermark


@pytest.mark.parametrize("mode, selected", [("BACKFILL", {"f-12-21"}), ("REPLAY", {"f-12-20", "f-12-21"})])
def test_only_replay_reads_loaded_files(spark, mode, selected):
    files = frame(spark, PARTITIONS)
    window = load_window(mode, start="2026-08-12T20", end="2026-08-12T21")
    rows = select_files(files, window, files.where("file_path = 'f-12-20'")).collect()
    assert {r.file_path for r in rows} == {"f-12-20", "f-12-21"}
    assert {r.file_path for r in rows if r.selected} == selected
    assert {r.file_path for r in rows if r.loaded_before} == {"f-12-20"}


def test_partition_token():
    assert parse_partition("2026-08-12T07") == (date(2026, 8, 12), 7)
    for bad in ("2026-08-12", "2026-08-12T7", "2026-08-12T24", "2026-08-12T007", "2026-13-01T00", "x"):
        with pytest.raises(ValueError):
            parse_partition(bad)


@pytest.mark.parametrize(
    "arguments",
    [
        {"mode": "BACKFILL", "start": "2026-08-12T20"},
        {"mode": "BACKFILL", "end": "2026-08-12T20"},
        {"mode": "BACKFILL", "start": "2026-08-12T20", "end": "2026-08-12T19"},
        {"mode": "REPLAY"},
        {"mode": "NORMAL", "start": "2026-08-12T20", "end": "2026-08-12T21"},
        {"mode": "SOMETIMES"},
    ],
)
def test_refused_arguments(arguments):
    with pytest.raises(ValueError):
        load_window(**arguments)
