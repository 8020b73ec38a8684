import hashlib

import numpy as np
import pytest

from orderlake.llm import quartile_digest as q


def counted(text: bytes) -> list[int]:
    out = [0] * q.BUCKETS
    for i in range(len(text) - 4):
        for kind, (a, b) in enumerate(q.TRIPLETS):
            h = text[i] * 0x9E3779B1 + text[i + a] * 0x85EBCA77 + text[i + b] * 0xC2B2AE3D + kind * 0x3D4D51CB
            h &= 0xFFFFFFFF
            h ^= h >> 15
            out[(h * 0x27D4EB2F & 0xFFFFFFFF) >> 25] += 1
    return out


def rows_of(texts):
    return q.digests(*q._joined([t.encode() for t in texts]))


def test_counts_of_many_texts_equal_those_of_each(monkeypatch):
    texts = [b"", b"abcd", b"abcde", b"hello world " * 9, bytes(range(200)), b"", b"x" * 50, b"tail"]
    for block in (1 << 17, 7):
        monkeypatch.setattr(q, "_BLOCK", block)
        assert q.bucket_counts(*q._joined(texts)).tolist() == [counted(t) for t in texts]


def test_hex_round_trip_and_bound():
    rows = rows_of(["", "some text here", "another text there " * 30, "z" * 5000])
    assert (q.from_hex(q.to_hex(rows)) == rows).all()
    assert q.difference(rows, rows).tolist() == [0] * 4
    every = q.likeness(np.repeat(rows, 4, axis=0), np.tile(rows, (4, 1)))
    assert every.min() >= 0 and every.max() == 1


def test_likeness_falls_with_edits():
    base = [f"word{i * 37 % 211}" for i in range(600)]
    other = [f"term{i * 53 % 199}" for i in range(600)]
    scores = [
        q.likeness(rows_of([" ".join(base)]), rows_of([" ".join(other[:n] + base[n:])]))[0] for n in (0, 60, 200, 600)
    ]
    assert scores == sorted(scores, reverse=True) and scores[0] == 1 and scores[-1] < scores[1] - 0.2


@pytest.mark.parametrize("parts", ["1", "4"])
def test_neighbours(spark, corpus, awkward, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for frame in (corpus, awkward, corpus.where("doc_id = 10"), corpus.limit(0)):
            rows = sorted(
                ((r.doc_id, r.text) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
            )
            got = sorted(tuple(r) for r in q.compare_neighbours(frame).selectExpr("coalesce(doc_id, -1)", "*").drop("doc_id").collect())
            expected = []
            for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
                text, after = text or "", after or ""
                n = len(text)
                edited = text[: n - n // 4] + after[: n // 4]
                a, e, b = rows_of([text, edited, after])
                expected.append(
                    (-1 if doc is None else doc, n, hashlib.sha256(edited.encode()).hexdigest(), *q.to_hex(np.array([a, e])),
                     q.likeness(a[None], e[None])[0], q.likeness(a[None], b[None])[0])
                )
            assert got == sorted(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_fingerprints_of_a_frame(awkward):
    rows = q.fingerprint(awkward).collect()
    assert [r.fingerprint for r in rows] == q.to_hex(rows_of([r.text or "" for r in rows]))


def test_texts_without_triplets_are_like_their_equals_only():
    texts = [b"", b"a", b"ab", b"cd", b"abc", b"ab", b"abcd", b"a\x00", b"", "é".encode(), b"abcde" * 9]
    rows = q.digests(*q._joined(texts))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            score = float(q.likeness(rows[i : i + 1], rows[j : j + 1])[0])
            assert (score == 1.0) == (a == b) and (a == b or score < 0.6), (a, b, score)
