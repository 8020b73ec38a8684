"""Locality-sensitive fingerprints by quartile bucket digests.

The byte triplets of every five-byte window are hashed into 128 buckets and counted; two bits per bucket say in which
quartile of the counts it lies, and a head keeps the logarithm of the length and two ratios of the quartiles. Digests
are compared by a difference score with a bound; likeness is one minus the score over the bound.

Null or empty text: no triplets, all buckets in the lowest quartile. A text of one to four bytes has no triplets either:
its buckets hold a hash of it, so that it is like its equals and hardly like any other. Equal texts have equal digests.
Ids are integers or text that reads as integers. Existing columns of the added names are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import extended, with_columns, without
from orderlake.llm.text import column_bytes, mix, slices

BUCKETS = 128
# Offsets in a window of the second and third byte of each triplet; the first byte is the window's own.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
BOUND = 256  # a difference of this much or more counts as no likeness at all
_WINDOW = 5
_BLOCK = 1 << 17
_FIRST, _SECOND, _THIRD, _SPREAD = (np.uint32(k) for k in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts per text and bucket of the hashed triplets of texts laid one after another."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, dtype=np.int64)
    for low in range(0, len(data) - _WINDOW + 1, _BLOCK):
        part = data[low : low + _BLOCK + _WINDOW - 1].astype(np.uint32)
        m = len(part) - _WINDOW + 1
        first_text = int(np.searchsorted(offsets, low, side="right")) - 1
        last_text = int(np.searchsorted(offsets, low + m - 1, side="right")) - 1
        inner = offsets[first_text + 1 : last_text + 1] - low
        edges = np.concatenate(([0], inner, [m]))
        text = np.repeat(np.arange(len(edges) - 1) * BUCKETS, np.diff(edges))
        # Windows that begin in one text and end in another; there are at most four before each edge.
        ends = offsets[first_text + 1 : last_text + 2] - low
        strays = np.unique(np.concatenate([ends - j for j in range(1, _WINDOW)]))
        strays = strays[(strays >= 0) & (strays < m)]
        if len(strays):
            strays = strays[np.searchsorted(offsets, low + strays + _WINDOW - 1, side="right")
                            != np.searchsorted(offsets, low + strays, side="right")]
        size = (len(edges) - 1) * BUCKETS
        own, second, third = part[:m] * _FIRST, part * _SECOND, part * _THIRD
        found = np.zeros(size, dtype=np.int64)
        for kind, (i, j) in enumerate(TRIPLETS):
            h = own + second[i : i + m] + third[j : j + m] + np.uint32(kind * 0x3D4D51CB & 0xFFFFFFFF)
            h ^= h >> np.uint32(15)
            h *= _SPREAD
            key = text + (h >> np.uint32(25))
            found += np.bincount(key, minlength=size)
            if len(strays):
                found -= np.bincount(key[strays], minlength=size)
        counts[first_text * BUCKETS : first_text * BUCKETS + size] += found
    return counts.reshape(n, BUCKETS)


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: length code, two quartile ratios, then the quartile (0 to 3) of each bucket."""
    counts = bucket_counts(data, offsets)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    out = np.zeros((len(counts), 3 + BUCKETS), dtype=np.uint8)
    out[:, 0] = np.minimum(255, np.floor(np.log1p(np.diff(offsets)) / np.log(1.1)))
    out[:, 1] = (q1 * 15) // np.maximum(q3, 1)
    out[:, 2] = (q2 * 15) // np.maximum(q3, 1)
    for q in (q1, q2, q3):
        out[:, 3:] += counts > q[:, None]
    size = np.diff(offsets)
    short = np.flatnonzero((size > 0) & (size < _WINDOW))
    if len(short):
        value = size[short].astype(np.uint64)
        for j in range(_WINDOW - 1):
            byte = data[np.minimum(offsets[short] + j, len(data) - 1)].astype(np.uint64)
            value = value * np.uint64(256) + np.where(j < size[short], byte, np.uint64(0))
        words = mix(value[:, None] * np.uint64(4) + np.arange(4, dtype=np.uint64))
        digits = words[:, :, None] >> np.arange(0, 64, 2, dtype=np.uint64) & np.uint64(3)
        out[short, 3:] = digits.reshape(len(short), BUCKETS)
    return out


def to_hex(rows: np.ndarray) -> list[str]:
    """68 hexadecimal digits each: length, ratios, buckets."""
    body = rows[:, 3:].reshape(len(rows), BUCKETS // 4, 4)
    packed = body[:, :, 0] | body[:, :, 1] << 2 | body[:, :, 2] << 4 | body[:, :, 3] << 6
    head = np.stack([rows[:, 0], rows[:, 1] << 4 | rows[:, 2]], axis=1)
    return [x.tobytes().hex() for x in np.concatenate([head, packed], axis=1).astype(np.uint8)]


def from_hex(texts: list[str]) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex("".join(texts)), dtype=np.uint8).reshape(len(texts), 2 + BUCKETS // 4)
    body = np.stack([raw[:, 2:] >> s & 3 for s in (0, 2, 4, 6)], axis=2).reshape(len(texts), BUCKETS)
    return np.concatenate([raw[:, :1], raw[:, 1:2] >> 4, raw[:, 1:2] & 15, body], axis=1)


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Score of pairs of digests: 0 for equal ones, at most ``BOUND``."""
    gap = np.abs(a.astype(np.int16) - b.astype(np.int16))
    body = gap[:, 3:].sum(axis=1) + 3 * (gap[:, 3:] == 3).sum(axis=1)
    return np.minimum(BOUND, np.minimum(2 * gap[:, 0], 24) + gap[:, 1] + gap[:, 2] + body)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - difference(a, b) / BOUND


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def fingerprint(df: DataFrame, text_col: str = "text", into: str = "fingerprint") -> DataFrame:
    """``df`` with the digest of each text."""
    base = without(df, [into])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            rows = digests(*column_bytes(batch.column(batch.schema.get_field_index(text_col))))
            yield with_columns(batch, (), **{into: pa.array(to_hex(rows))})

    return base.mapInArrow(run, extended(base, f"`{into}` string"))


_NO_ID = -(1 << 63)  # null ids come before all others


def _deal(bounds: list[int], least: int):
    """Rows with their range of ids; the first row of a range goes to the range before it as well."""
    limits, starts = np.array(bounds, dtype=np.int64), {least: len(bounds), **{b: i for i, b in enumerate(bounds)}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            copied = np.flatnonzero(np.isin(ids, np.fromiter(starts, dtype=np.int64)))
            bucket = np.searchsorted(limits, ids, side="right")
            before = np.array([starts[i] for i in ids[copied].tolist()], dtype=np.int64)
            for rows, to, border in ((None, bucket, False), (pa.array(copied), before, True)):
                if rows is not None and not len(rows):
                    continue
                part = batch if rows is None else batch.take(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), pa.array([border] * len(to)), *part.columns],
                    ["bucket", "border", "id", "text"],
                )

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the next of its range, over rows sorted by range, border and id."""
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held: list[tuple] = []
    for batch in slices(batches, "text"):
        rows = held + list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        held = rows[-1:]
        if len(rows) < 2:
            continue
        texts = [r[3] or "" for r in rows]
        own = [t.encode() for t in texts]
        edited = []
        for text, after in zip(texts, texts[1:], strict=False):
            quarter = len(text) // 4
            edited.append((text[: len(text) - quarter] + after[:quarter]).encode())
        a, e = digests(*_joined(own)), digests(*_joined(edited))
        keep = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
        if not keep:
            continue
        at = np.array(keep)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][2] for i in keep], pa.int64()),
                pa.array([len(texts[i]) for i in keep], pa.int64()),
                pa.array([hashlib.sha256(edited[i]).hexdigest() for i in keep]),
                pa.array(to_hex(a[at])),
                pa.array(to_hex(e[at])),
                pa.array(likeness(a[at], e[at])),
                pa.array(likeness(a[at], a[at + 1])),
            ],
            names,
        )


def compare_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text against itself with its last quarter taken from the next text, and against the next text.

    Next is by ascending id (null ids first, equal ids by text), after the last the first. Ranges of ids are
    shuffled and sorted once; each gets a copy of the row that follows its last one, so no order is global. The
    driver sees the ids that bound the ranges, eight for each shuffle partition.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("id", F.lit(_NO_ID))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    least, found = rows.agg(F.min(key), F.percentile_approx(key, shares, F.lit(10 * parts))).first()
    bounds = sorted(set(found or ()) - {least})
    schema = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double"  # fmt: skip
    dealt = rows.mapInArrow(
        _deal(bounds, _NO_ID if least is None else least), "bucket int, border boolean, id bigint, text string"
    )
    ordered = dealt.repartition("bucket").sortWithinPartitions(
        "bucket", "border", F.asc_nulls_first("id"), F.asc_nulls_first("text")
    )
    return ordered.mapInArrow(_compare, schema).withColumnRenamed("id", id_col)
