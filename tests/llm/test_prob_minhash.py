import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import prob_minhash as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(text)
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard(a, b):
    if not a or not b:
        return 0.0
    keys = list(a.keys() | b.keys())
    p, q = (np.array([c[k] for k in keys], float) for c in (a, b))
    both = np.flatnonzero((p > 0) & (q > 0))
    if p.max() == q.max() == 1:
        return len(both) / len(keys)
    return sum(1 / np.maximum(p / p[x], q / q[x]).sum() for x in both)


def classes(rows):
    """Smallest id linked to each id, over all pairs of texts."""
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, t, shingles(t)) for d, t in rows]
    for i, (d, t, s) in enumerate(sets):
        for e, u, r in sets[:i]:
            if t == u or (len(s.keys() & r.keys()) > 0.4 * min(len(s), len(r)) and jaccard(s, r) >= 0.8):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in rows}


def test_classes_equal_all_pairs(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    got = {r.doc_id: r.class_id for r in m.near_duplicates(corpus).collect()}
    expected = classes(rows)
    assert got == expected
    assert len(set(expected.values())) < len(rows) - 20


def test_awkward_rows(awkward):
    rows = m.near_duplicates(awkward.withColumnRenamed("n_words", "class_id")).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert (r.class_id is None) == (r.doc_id is None)
        assert r.class_id == (4 if r.doc_id == 5 else r.doc_id)
    assert m.near_duplicates(awkward.limit(0)).count() == 0


def test_links_count_different_texts_only(spark):
    base = [f"w{i}" for i in range(100)]
    near = [*base[:-1], "z"]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, "quite another text of a few words")]
    got = m.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [(r.class_id, r.copy_of, r.n_links) for r in got] == [(1, 1, 1), (1, 1, 1), (1, 3, 1), (4, 4, 0)]


def test_links_between_members_that_are_no_ends(spark):
    """A chain whose neighbours are alike and whose ends are not is one class."""
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words[20 * i : 20 * i + 12] = [f"v{i}x{j}" for j in range(12)]
    got = {r.class_id for r in m.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == set(classes(rows).values()) == {0}


def test_signatures_estimate_the_likeness():
    rng = np.random.default_rng(5)
    n = 200
    p = rng.integers(0, 5, n)
    q = np.where(rng.random(n) < 0.7, p, rng.integers(0, 6, n))
    exact = m.probability_jaccard(p.astype(float), q.astype(float))
    shares = []
    for k in range(30):
        element = m.mix(np.arange(n, dtype=np.uint64) + np.uint64(1000 * k + 1))
        won = [m.signatures(np.zeros((w > 0).sum(), int), element[w > 0], w[w > 0], 1)[0] for w in (p, q)]
        shares.append((won[0] == won[1]).mean())
    assert np.mean(shares) == pytest.approx(exact, abs=0.04)


def test_exact_likeness_of_pairs():
    left = ["a b c d e f g", "x y", "a b c d e " * 4, "", "one two three four five six"]
    right = ["a b c d e f h", "x y", "a b c d e " * 3 + "f", "", "seven"]
    got = m.similarities(pa.array(left), pa.array(right))
    expected = [jaccard(shingles(a), shingles(b)) for a, b in zip(left, right, strict=True)]
    assert got.tolist() == pytest.approx(expected)


def test_large_bands_are_searched_in_full(spark, monkeypatch):
    """Lightly edited texts inside a group of heavily edited ones: near each other only; one leader drawn."""
    monkeypatch.setattr(m, "LEADERS", 1)
    rng = np.random.default_rng(3)
    rows = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(120)]
        for i in range(400):
            light = i >= 398
            words = base.copy()
            for k, at in enumerate([40 + 40 * (i % 2)] if light else rng.choice(np.arange(5, 115), 6, replace=False)):
                words[at] = f"g{group}x{i}y{k}"
            rows.append((len(rows), " ".join(words)))
    seen = {}
    for d, text in rows:
        for s in shingles(text):
            seen.setdefault(s, []).append(d)
    size = np.array([len(shingles(t)) for _, t in rows])
    shared = np.zeros((len(rows), len(rows)), dtype=np.int32)
    for ds in seen.values():
        if len(ds) > 1:
            shared[np.ix_(ds, ds)] += 1
    near = shared >= 0.8 * (size[:, None] + size - shared)
    expected = list(range(len(rows)))
    for a, b in np.argwhere(np.triu(near, 1)):
        low, high = sorted((expected[a], expected[b]))
        expected = [low if x == high else x for x in expected]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in m.near_duplicates(frame).collect()}
    assert got == dict(enumerate(expected))
    assert len(set(expected)) < len(rows)


def test_searched_pairs_hold_all_near_ones(spark):
    """Also of texts that repeat shingles, and when few counts order the shingles."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(30)] * 2 + [f"v{i}" for i in range(25)]
    rows = []
    for i in range(120):
        words = base[: 55 + i % 31]
        for at in rng.integers(0, len(words), i % 4):
            words[at] = f"x{rng.integers(0, 6)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc bigint, text string")
    pairs = m._searched(frame.selectExpr("doc", "doc AS label"), frame, 0.8).collect()
    sets = [shingles(t) for _, t in rows]
    near = {(a, b) for b in range(120) for a in range(b) if jaccard(sets[a], sets[b]) >= 0.8}
    assert near <= {(r.a, r.b) for r in pairs} and len(near) > 100
