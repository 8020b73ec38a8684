import gzip
import hashlib

import pytest

from orderlake.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    big, bigger = "<p>same</p>" * 100, "é" * 600
    rows = [
        (1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9", big), (3, "http://b/\r\nx", "small"),
        (4, None, "small"), (5, "http://c", None), (6, "http://c", ""), (7, "http://d", bigger), (8, "http://d", bigger),
        (None, "http://e", big), (10, "http://f", "x\r\n\r\ny" * 3), (11, "http://g", "a" * 999), (12, "http://g", "a" * 999),
        (13, "http://h", "unique " * 5000),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def test_records_come_back(pages, tmp_path):
    index, root = warc.write_archives(pages, str(tmp_path / "archive"))
    got = {r.id: r for r in warc.read_records(index, root).collect()}
    rows = pages.collect()
    assert len(got) == len(rows) == index.count()
    best = {}
    for r in rows:
        if len((r.html or "").encode()) >= 1000 and r.page_id is not None:
            best[r.html] = max(r.page_id, best.get(r.html, 0))
    for r in rows:
        data = (r.html or "").encode()
        record = got[r.page_id]
        refers = best[r.html] if r.html in best and best[r.html] != r.page_id else None
        assert record.refers_to == refers
        assert record.record_type == ("response" if refers is None else "revisit")
        assert (record.payload_bytes, record.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert record.payload is None if refers else bytes(record.payload) == data
    assert index.select("file").distinct().count() >= 1


def test_archives_are_plain_gzip_members(pages, tmp_path):
    index, root = warc.write_archives(pages, str(tmp_path / "archive"))
    row = index.where("id = 10").first()
    with open(f"{root.removeprefix('file://')}/{row.file}", "rb") as file:
        file.seek(row.offset)
        record = gzip.decompress(file.read(row.length))
    assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"x\r\n\r\ny" * 3 + b"\r\n\r\n")


def test_selected_records_only(pages, tmp_path):
    index, root = warc.write_archives(pages, str(tmp_path / "archive"))
    got = warc.read_records(index.where("id IN (3, 13)"), root, payloads=False).collect()
    assert sorted(r.id for r in got) == [3, 13] and all(r.payload is None for r in got)


def test_equal_ids_and_empty_tables(spark, tmp_path):
    rows = [(1, "u", "z" * 2000), (1, "u", "z" * 2000), (2, "v", "z" * 2000), (2, "w", "z" * 2000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    index, root = warc.write_archives(frame, str(tmp_path / "a"))
    got = warc.read_records(index, root).collect()
    assert sorted(r.record_type for r in got) == ["response", "revisit", "revisit", "revisit"]
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {2}
    index, root = warc.write_archives(frame.limit(0), str(tmp_path / "b"))
    assert warc.read_records(index, root).count() == 0


def test_ranges_are_coalesced_and_bounded(monkeypatch):
    monkeypatch.setattr(warc, "GAP_BYTES", 10)
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    rows = [("a", 0, 30), ("a", 30, 30), ("a", 65, 30), ("a", 95, 30), ("a", 500, 300), ("b", 0, 5)]
    reads = [(f, b, e, len(inside)) for f, b, e, inside in warc._ranges(rows)]
    assert reads == [("a", 0, 95, 3), ("a", 95, 125, 1), ("a", 500, 800, 1), ("b", 0, 5, 1)]


def test_changed_payload_is_noticed():
    record = warc.build_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"payload\r", b"PAYLOAD\r"))
