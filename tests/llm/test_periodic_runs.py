"""Extensions, runs and collapsed texts against plain comparisons."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from orderlake.llm.lce import COVER, PERIOD, Extensions
from orderlake.llm.periodic_runs import find_runs, runs_of
from orderlake.llm.queries import op11_periodic_runs


def plain_runs(words, exponent=4, shortest=6):
    n, out = len(words), []
    for start in range(n):
        for q in range(1, n // exponent + 1):
            if start and start + q <= n and words[start - 1] == words[start + q - 1]:
                continue
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            run = words[start : start + length]
            if length >= max(shortest, exponent * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng, alphabet):
    words = [rng.randrange(alphabet) for _ in range(rng.choice([0, 1, 5, 6, 7, 40, 90]))]
    if words and rng.random() < 0.6:
        words = (words[: rng.randint(1, len(words))] * rng.randint(1, 9))[:170]
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = 77
    return words


def test_every_difference_is_covered():
    differences = {(a - b) % PERIOD for a in COVER for b in COVER}
    assert differences == set(range(PERIOD))


@pytest.mark.parametrize("alphabet", [1, 2, 30])
def test_extensions(alphabet):
    rng = random.Random(alphabet)
    for n in (1, 2, 30, 400):
        seq = np.array([rng.randrange(alphabet) for _ in range(n)] + [alphabet])
        pairs = [(a, b) for a, b in ((rng.randrange(n + 1), rng.randrange(n + 1)) for _ in range(300)) if a != b]
        expected = []
        for a, b in pairs:
            k = 0
            while max(a, b) + k <= n and seq[a + k] == seq[b + k]:
                k += 1
            expected.append(k)
        a, b = np.array(pairs).reshape(-1, 2).T
        assert Extensions(seq).of(a, b).tolist() == expected


@pytest.mark.parametrize("alphabet", [1, 2, 3, 6])
@pytest.mark.parametrize("exponent,shortest", [(4, 6), (2, 2), (3, 10)])
def test_runs_equal_plain_search(alphabet, exponent, shortest):
    rng = random.Random(10 * alphabet + exponent)
    for _ in range(25):
        texts = [some_words(rng, alphabet) for _ in range(rng.randint(1, 5))]
        first = np.cumsum([0] + [len(t) for t in texts])
        words = np.array(sum(texts, []), dtype=np.uint64)
        found = list(zip(*(x.tolist() for x in runs_of(words, first, exponent, shortest)), strict=True))
        for i, text in enumerate(texts):
            assert [r[1:] for r in found if r[0] == i] == plain_runs(text, exponent, shortest), text


def test_no_texts():
    assert all(len(x) == 0 for x in runs_of(np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)))


def test_long_texts_of_one_run():
    n = 300_000
    for period in (1, 2, 977):
        words = (np.arange(n) % period).astype(np.uint64)
        assert [x.tolist() for x in runs_of(words, np.array([0, n]))] == [[0], [0], [n], [period]]


def test_awkward_documents(spark, awkward):
    docs = awkward.withColumn("runs", awkward.source).withColumnRenamed("source", "a.b")  # clash, and a dotted name
    found = find_runs(docs)
    assert found.columns == ["doc_id", "text", "a.b", "n_words", "runs", "strongest", "collapsed_text"]
    rows = found.collect()
    assert len(rows) == awkward.count()
    for row in rows:
        words = (row.text or "").split()
        assert row.n_words == len(words)
        if len(words) < 1000:
            runs = plain_runs(words)
            assert [tuple(r) for r in row.runs] == runs
            assert row.collapsed_text == plain_collapse(words, runs)
        else:
            assert [tuple(r) for r in row.runs] == [(0, 60_000, 977)]
            assert len(row.collapsed_text.split()) == 977
    assert find_runs(docs.limit(0)).collect() == []


def test_strongest_run(spark):
    #: equal quotients: the earlier one; the greater quotient wins over the longer run
    text = "a b a b a b a b x c c c c c c c c c y d e d e d e d e z f f f f f f f f f"
    row = find_runs(spark.createDataFrame([(text,)], "text string")).first()
    assert tuple(row.strongest) == (9, 9, 1)
    assert [tuple(r) for r in row.runs] == [(0, 8, 2), (9, 9, 1), (19, 8, 2), (28, 9, 1)]


def contract_row(doc_id, text):
    """The row that the query is to return, by plain loops."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join("{},{},{}\n".format(*r) for r in runs)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest(),
    )


def test_query_equals_plain_loops(spark, tmp_path):
    rng = random.Random(4)
    texts = [rng.choice([" ", "\n", "\t "]).join(f"w{w}é" for w in some_words(rng, 4)) for _ in range(300)]
    texts += [None, "", " \n", "x", "a " * 30, " ".join(f"u{i}" for i in range(200))]
    rows = list(enumerate(texts))
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.withColumn("lang", docs.text).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect())
    assert found == [contract_row(*r) for r in rows]
