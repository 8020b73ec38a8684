"""WARC archives with an index: records are located first, then read by coalesced byte ranges.

``write_archives`` writes one gzip member per record and gives the index: file, offset, length, URL and digest of
each. The index is a Parquet table and is what counts: a task that is run again writes files of its own under a new
name, and only those in the index are ever read. ``read_records`` sorts the selected index rows by file and offset,
merges ranges that lie close together into one read, and parses the records in them.

Of records with equal payloads of at least ``revisit_bytes`` the one with the largest id is a response, the others are
revisits without payload. The largest id per digest is aggregated before the shuffle; pages find it in a join that
adaptive execution can split, so a payload that a third of all pages share stays no single task's work.

Null payload: empty. Null id: rank below all ids. Rows that repeat an id: each is a record of its own; of those with
the largest id one is the response (the smallest URL, then any), and revisits refer to its id. Files are reached
through ``pyarrow.fs``, so the folder may be on any file system it knows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import table
from orderlake.session import scratch_root

FILE_BYTES = 256 << 20  # a file is closed when it has grown beyond this
GAP_BYTES = 64 << 10  # unselected bytes that are read rather than skipped
READ_BYTES = 8 << 20  # one read, unless a record alone is longer
INDEX = "file string, offset bigint, length bigint, id bigint, url string, digest string, record_type string"
RECORD = "id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, " \
         "refers_to bigint"  # fmt: skip


def _clean(value) -> str:
    return "" if value is None else str(value).replace("\r", " ").replace("\n", " ")


def _b32(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def build_record(page: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None) -> bytes:
    """One record, not compressed. A revisit keeps the HTTP head, which tells the length of its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}#{_clean(url)}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: {_b32(sha1_hex)}",
        f"X-Page-ID: {'' if page is None else page}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _head(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)}, rest


def parse_record(raw: bytes) -> dict:
    """Fields of a record; the digest and length of a response are those of the payload read."""
    head, rest = _head(raw)
    http, body = _head(rest[: int(head["content-length"])])
    revisit = head["warc-type"] == "revisit"
    stated = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    length = int(http["content-length"])
    if not revisit and (hashlib.sha1(body).hexdigest() != stated or len(body) != length):
        raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
    return {
        "id": int(head["x-page-id"]) if head["x-page-id"] else None,
        "url": head["warc-target-uri"],
        "record_type": head["warc-type"],
        "payload": None if revisit else body,
        "payload_bytes": length,
        "payload_digest": stated,
        "refers_to": int(head["x-refers-to-page-id"]) if revisit else None,
    }


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        names = ["file", "offset", "length", "id", "url", "digest", "record_type"]
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    record = _gzip(build_record(page, url, (payload or "").encode(), digest, refers_to))
                    out.write(record)
                    kind = "response" if refers_to is None else "revisit"
                    rows.append((name, at, len(record), page, url, digest, kind))
                    at += len(record)
                if rows:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
                    )
        finally:
            if out is not None:
                out.close()

    return run


def with_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_bytes: int = 1000,
) -> DataFrame:
    """(id, url, payload, digest, refers_to) of each page; ``refers_to`` is null for responses."""
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(payload_col).alias("payload"),
        F.sha1(F.coalesce(payload_col, F.lit(""))).alias("digest"),
        F.octet_length(F.coalesce(payload_col, F.lit(""))).alias("size"),
    )
    rank = F.struct(F.col("id").alias("id"), F.xxhash64("url").alias("tie"))
    groups = (
        rows.where(F.col("size") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max(rank).alias("best"), F.count("*").alias("n"))
        .where("n > 1 AND best.id IS NOT NULL")
        .select(F.col("digest").alias("group_digest"), "best")
    )
    met = rows.join(groups, (F.col("digest") == F.col("group_digest")) & (F.col("size") >= revisit_bytes), "left")
    revisit = F.col("best").isNotNull() & ~rank.eqNullSafe(F.col("best"))
    return met.select("id", "url", "payload", "digest", F.when(revisit, F.col("best.id")).alias("refers_to"))


def write_archives(pages: DataFrame, root: str | None = None, **columns) -> tuple[DataFrame, str]:
    """Write archives of pages; returns their index, a written table, and the folder they are in."""
    spark = pages.sparkSession
    root = root or f"{scratch_root(spark)}/llm/warc-{uuid.uuid4().hex}"
    if "://" not in root and ":/" not in root:
        root = f"file://{root}"
    root = root.replace("file:/", "file:///", 1) if root.startswith("file:/") and "://" not in root else root
    store, base = fs.FileSystem.from_uri(root)
    store.create_dir(base, recursive=True)
    return table(with_revisits(pages, **columns).mapInArrow(_writer(root), INDEX), "warc-index"), root


def _ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Reads that cover sorted (file, offset, length) rows: file, begin, end, and the records inside."""
    file, begin, end, inside = None, 0, 0, []
    for name, offset, length in rows:
        if name == file and offset - end <= GAP_BYTES and offset + length - begin <= READ_BYTES:
            inside.append((offset, length))
            end = max(end, offset + length)
            continue
        if inside:
            yield file, begin, end, inside
        file, begin, end, inside = name, offset, offset + length, [(offset, length)]
    if inside:
        yield file, begin, end, inside


def _reader(root: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        schema = pa.schema(
            [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for file, begin, end, inside in _ranges(rows):
                with store.open_input_file(f"{base}/{file}") as source:
                    data = source.read_at(end - begin, begin)
                records = [
                    parse_record(zlib.decompress(data[o - begin : o - begin + n], 31)) for o, n in inside
                ]
                if not payloads:
                    for r in records:
                        r["payload"] = None
                yield pa.RecordBatch.from_pylist(records, schema)

    return run


def read_records(index: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """Records of the selected index rows; rows of one stretch of a file are read by one task, in order."""
    rows = index.select("file", "offset", "length")
    stretch = F.floor(F.col("offset") / (8 * READ_BYTES))
    # A fixed number of tasks: by its own few bytes an index would be coalesced into one.
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "file", stretch).sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(_reader(root, payloads), RECORD)
