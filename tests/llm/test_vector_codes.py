"""Codes and codebooks against Lloyd's rounds in plain Python."""

import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import vector_codes as v
from orderlake.llm.queries import ORACLE_SQL, op12_vector_codes
from orderlake.session import scratch_root


def plain_codes(vectors, parts=8, entries=16, rounds=6):
    """Codes and errors of integer vectors in the order of their ids, and the entries, by loops over everything."""
    bounds = [i * len(vectors[0]) // parts for i in range(parts + 1)]
    cut = [[x[bounds[p] : bounds[p + 1]] for p in range(parts)] for x in vectors]
    books = [[list(x[p]) for x in cut[:entries]] for p in range(parts)]
    nearest = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut:
                groups.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            for entry, members in groups.items():
                books[p][entry] = [sum(c) // len(members) for c in zip(*members)]
    best = [[nearest(x[p], books[p]) for p in range(parts)] for x in cut]
    return [[i for _, i in b] for b in best], [sum(d for d, _ in b) for b in best], books


def random_vectors(n, dimension, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dimension)] for _ in range(5)]
    return [[float(np.float32(c + rng.gauss(0, 0.2))) for c in rng.choice(centres)] for _ in range(n)]


def integers(vectors):
    return [[math.floor(4096 * x) for x in row] for row in vectors]


@pytest.mark.parametrize("n,dimension,parts", [(120, 16, 8), (40, 21, 4), (9, 8, 8), (30, 3, 8)])
def test_codes_equal_plain_rounds(spark, n, dimension, parts):
    vectors = random_vectors(n, dimension, n)
    codes, errors, books = plain_codes(integers(vectors), parts)
    order = list(range(n))
    random.Random(1).shuffle(order)
    frame = spark.createDataFrame([(i, vectors[i]) for i in order], "vec_id bigint, embedding array<float>")
    coded, found = v.compress_vectors(frame.repartition(3), parts=parts)
    rows = sorted(coded.collect())
    assert [r.codes for r in rows] == codes
    assert [r.error for r in rows] == errors
    for p in range(parts):
        a, b = found.bounds[p : p + 2]
        assert found.entries[:, a:b].tolist() == books[p]


def test_moved_entries_only_give_what_a_full_scan_gives():
    rng = np.random.default_rng(5)
    for _ in range(200):
        part = rng.integers(-3, 4, (60, 2))  # many equal distances
        old = rng.integers(-3, 4, (7, 2))
        moved = rng.random(7) < 0.4
        new = np.where(moved[:, None], rng.integers(-3, 4, (7, 2)), old)
        code, far = v.reassign(part, old, np.ones(7, bool), np.full(60, -1), np.zeros(60, np.int64))
        full = v.distances(part, new)
        got = v.reassign(part, new, moved, code, far)
        assert got[0].tolist() == full.argmin(axis=1).tolist()
        assert got[1].tolist() == full.min(axis=1).tolist()


def test_only_parts_of_moved_entries_are_scanned_again(monkeypatch):
    part, entries = np.arange(100)[:, None], np.arange(0, 100, 10)[:, None]
    code, far = v.reassign(part, entries, np.ones(10, bool), np.full(100, -1), np.zeros(100, np.int64))
    asked = []
    plain = v.distances
    monkeypatch.setattr(v, "distances", lambda p, e: asked.append((len(p), len(e))) or plain(p, e))
    moved = np.arange(10) == 3
    v.reassign(part, entries, moved, code, far)
    assert asked == [(int((code != 3).sum()), 1), (int((code == 3).sum()), 10)]


def test_large_components_are_exact():
    part = np.array([[v.LARGEST, -v.LARGEST], [5, 6]])
    entries = np.array([[-v.LARGEST, v.LARGEST], [5, 7], [5, 5]])
    expected = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)) for e in entries] for x in part]
    assert v.distances(part, entries).tolist() == expected


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    sound = random_vectors(20, 8, 3)
    rows = [(i, x, "a", 1) for i, x in enumerate(sound)]
    rows += [
        (50, None, "a", 1), (51, [1.0] * 7 + [None], "a", 1), (52, [nan] + [1.0] * 7, "a", 1), (53, [-inf] * 8, "a", 1),
        (54, [1.0] * 7, "a", 1), (55, [], "a", 1), (56, [30000.0] * 8, None, 1), (None, sound[3], None, None),
        (3, sound[3], "a", 1), (3, sound[3], "a", 1),
    ]
    frame = spark.createDataFrame(rows, "`vec.id` bigint, embedding array<float>, `a b` string, Codes int").repartition(4)
    coded, books = v.compress_vectors(frame, id_col="vec.id")
    assert coded.columns == ["vec.id", "embedding", "a b", "codes", "error"]
    got = coded.collect()
    assert sorted(r[0] for r in got if r[0] is not None) == sorted([*range(20), 3, 3, 54, 55, 56])
    whole = integers(sound)
    ordered = [whole[i] for i in range(20) for _ in range(3 if i == 3 else 1)] + [whole[3]]
    codes, errors, _ = plain_codes(ordered)
    ids = [i for i in range(20) for _ in range(3 if i == 3 else 1)] + [None]
    expected = {(i, tuple(c), e) for i, c, e in zip(ids, codes, errors)}
    assert {(r[0], tuple(r.codes), r.error) for r in got if r.codes is not None} == expected
    assert {r[0] for r in got if r.codes is None} == {54, 55, 56}
    assert all(r.error is None for r in got if r.codes is None)
    labelled = v.with_label_error(coded, "a b").collect()
    assert len(labelled) == len(got)
    for label in ("a", None):
        sums = {r.label_error for r in labelled if r["a b"] == label}
        assert sums == {sum(r.error for r in got if r["a b"] == label and r.error is not None)}


def test_no_sound_vectors(spark):
    frame = spark.createDataFrame([(1, None), (2, [None])], "vec_id bigint, embedding array<float>")
    for given in (frame, frame.limit(0)):
        coded, books = v.compress_vectors(given)
        assert books is None and coded.collect() == []


def test_tables_of_earlier_rounds_are_deleted(spark):
    folder = f"{scratch_root(spark)}/llm"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    frame = spark.createDataFrame(list(enumerate(random_vectors(30, 8, 2))), "vec_id bigint, embedding array<float>")
    v.compress_vectors(frame)
    assert len(set(os.listdir(folder)) - before) == 1


def test_integers_are_floors():
    whole, rows = v.to_integers(pa.array([[-0.00001, 0.5], None, [1.0], [2.0, -2.0]], pa.list_(pa.float32())), 2)
    assert rows.tolist() == [0, 3] and whole.tolist() == [[-1, 2048], [8192, -8192]]


def test_query_equals_plain_rounds(spark, tmp_path):
    vectors = random_vectors(90, 64, 8)
    rows = [(i, x, i % 3 or None) for i, x in enumerate(vectors)] + [(200, None, 1), (201, [None] * 64, 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    frame.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    codes, errors, books = plain_codes(integers(vectors))
    got = {r.vec_id: r for r in op12_vector_codes(spark, str(tmp_path)).collect()}
    assert len(got) == 90 and "op12_vector_codes" in ORACLE_SQL
    bounds = v.bounds_of(64, 8)
    whole = np.concatenate([np.array(b) for b in books], axis=1)
    for i in range(90):
        assert got[i].code == "".join(f"{c:02x}" for c in codes[i])
        assert got[i].error == errors[i]
        assert got[i].label_error == sum(errors[i % 3 :: 3])
        assert got[i].codebooks_sha256 == v.Codebooks(whole, bounds).digest()
