import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import lm_scoring as lm

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall((text or "").encode().lower()), b"\nend"]


def base(rows):
    """Per row: tokens, known tokens, base score; and the number of training tokens."""
    counts = Counter()
    for doc, text in rows:
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 10:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    scale = math.log10(total + 0.1 * (distinct + 1))
    out = []
    for _, text in rows:
        own = tokens(text)
        out.append((len(own), sum(counts[t] > 0 for t in own), sum(math.log10(counts[t] + 0.1) - scale for t in own)))
    return out, total


@pytest.mark.parametrize("front", [1 << 18, 30])
def test_base_scores_are_exact(corpus, awkward, monkeypatch, front):
    monkeypatch.setattr(lm, "FRONT", front)  # the smaller front sends most tokens through the join
    for frame in (corpus, awkward):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        expected, total = base(rows)
        got = lm.train_and_score(frame).collect()
        key = lambda x: (x[0], round(x[2], 6))
        assert sorted(((r.n_tokens, r.n_known, r.base_score) for r in got), key=key) == [
            (n, k, pytest.approx(s, rel=1e-9)) for n, k, s in sorted(expected, key=key)
        ]
        assert {r.train_tokens for r in got} == {total}
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_probabilities_of_units_sum_to_one():
    rng = np.random.default_rng(1)
    shares = rng.random(lm.UNITS)
    vectors = lm.Vectors.start(shares / shares.sum())
    before = rng.integers(0, lm.UNITS + 1, (5, lm.CONTEXT))
    total = sum(np.exp(vectors.log_probabilities(before, np.full(5, u))) for u in range(lm.UNITS))
    assert np.allclose(total, 1, atol=1e-4)


def test_probabilities_of_a_shared_unit_sum_to_its_own(spark):
    texts = spark.createDataFrame([(" ".join(f"w{i}" for i in range(900)) + " w1" * 5,)], "text string")
    counts = lm.count_tokens(texts)
    model = lm.prepare(counts)
    rows = counts.toPandas()
    found = model.look_up(rows["token"].to_numpy().view(np.uint64))
    own = found[2] >= 0
    for part in range(lm.SHARED):
        inside = rows["n"][(rows["part"] == part) & ~own]
        assert (inside + lm.SMOOTH).sum() + lm.SMOOTH == pytest.approx(model.mass[part])


def test_model_learns_from_context():
    units = np.tile([3, 5, 9, 11], 3000).astype(np.int32)
    shares = np.full(lm.UNITS, 1 / lm.UNITS)
    trainer = lm.Trainer(lm.Vectors.start(shares), shares)
    before = lm.contexts(units, np.array([0, len(units)]))
    for _ in range(20):
        for low in range(0, len(units), lm.BATCH):
            trainer.step(before[low : low + lm.BATCH], units[low : low + lm.BATCH])
    logs = trainer.v.log_probabilities(before[100:200], units[100:200])
    assert logs.mean() > -0.7 > math.log(1 / lm.UNITS)


def test_contexts_stop_at_text_borders():
    got = lm.contexts(np.array([1, 2, 3, 4], np.int32), np.array([0, 3, 4]))
    b = lm.BEGIN
    assert got.tolist() == [[b, b, b, b], [1, b, b, b], [2, 1, b, b], [b, b, b, b]]


def test_only_ascii_is_lowered():
    got = lm.tokens_of(pa.array(["ABC É", "abc é", "abc É"])).hashes.reshape(3, 3)
    assert got[0, 0] == got[1, 0] and got[0, 1] != got[1, 1] and got[0, 1] == got[2, 1]


def test_spellings_of_a_word_are_one_token(spark, monkeypatch):
    rows = [(i, w) for i, w in enumerate(["ABC x", "abc X", "Abc", "aBC q", "abC", "éB Z", "éb z", "B", "b", "new"] * 4)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    counts = lm.count_tokens(frame.select("text"))
    assert counts.count() == counts.select("token").distinct().count() == 8
    expected, total = base(rows)
    for front in (1 << 18, 0):  # without a front all counts come through the join
        monkeypatch.setattr(lm, "FRONT", front)
        got = lm.train_and_score(frame).orderBy("doc_id").collect()
        assert [(r.n_tokens, r.n_known) for r in got] == [(n, k) for n, k, _ in expected]
        assert [r.base_score for r in got] == pytest.approx([s for _, _, s in expected], rel=1e-9)


def test_held_out_text_scores_above_the_base(spark):
    lines = ["red blue green yellow", "un deux trois quatre"]
    rows = [(i, " ".join([lines[i % 2]] * 40)) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = [r for r in lm.train_and_score(frame).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_table(spark):
    assert lm.train_and_score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_words_beyond_the_first_hundred_have_units_of_their_own(spark):
    text = " ".join(" ".join([f"w{i}x"] * (400 - i)) for i in range(185))
    counts = lm.count_tokens(spark.createDataFrame([(text,)], "text string"))
    model = lm.prepare(counts)
    own = model.look_up(counts.toPandas()["token"].to_numpy().view(np.uint64))[2]
    assert len(own) == 186 and (own >= 0).sum() >= 184  # two may meet in a slot
