import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.llm import mixing


def mixed(frame, **options):
    return mixing.mix_sources(frame, **options).collect()


def sources(rows):
    tokens, taken, weight = defaultdict(int), defaultdict(int), {}
    for r in rows:
        tokens[r.source] += r.n_tokens
        taken[r.source] += r.n_tokens * r.copies
        weight[r.source] = r.weight
    return tokens, taken, weight


def test_entropy_target_and_budget(corpus):
    rows = mixed(corpus, target_entropy=0.98)
    tokens, taken, weight = sources(rows)
    total = sum(tokens.values())
    entropy = -sum(w * math.log(w) for w in weight.values()) / math.log(len(weight))
    assert entropy == pytest.approx(0.98, abs=1e-4) and sum(weight.values()) == pytest.approx(1)
    longest = max(r.n_tokens for r in rows)
    for source, w in weight.items():
        assert w * total - longest - 1 <= taken[source] <= w * total


def test_copies_follow_the_block_order(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 300)
    rows = mixed(corpus, target_entropy=0.99, budget=9000)
    tokens, taken, weight = sources(rows)
    for source in tokens:
        assert taken[source] <= weight[source] * 9000
        assert {r.copies for r in rows if r.source == source} <= {
            int(weight[source] * 9000 // tokens[source]) + i for i in (0, 1)
        }


def test_repetition_limit(corpus):
    tokens, _, weight = sources(mixed(corpus, max_repetition=1.3))
    total = sum(tokens.values())
    assert max(weight[s] * total / tokens[s] for s in tokens) == pytest.approx(1.3, abs=1e-3)


def test_keep_all_leaves_nothing_out(corpus):
    rows = mixed(corpus, max_repetition=1.5, keep_all=True)
    tokens, taken, _ = sources(rows)
    largest = max(tokens, key=tokens.get)
    assert min(r.copies for r in rows) == 1 and taken[largest] == tokens[largest]
    assert 1.2 < max(taken[s] / tokens[s] for s in tokens) <= 1.5
    frame = mixing.mix_sources(corpus, max_repetition=1.5, keep_all=True)
    out = mixing.realise(frame)
    assert out.columns == corpus.columns and out.count() == sum(r.copies for r in rows)


def test_awkward_rows(awkward):
    rows = mixed(awkward.withColumn("copies", F.lit("old")), target_entropy=0.5)
    assert len(rows) == awkward.count()
    assert all(r.copies >= 0 and r.n_tokens >= 0 and r.weight is not None for r in rows)
    for r in rows:
        if r.source is None:
            assert (r.weight, r.copies) == (0.0, 0)  # a source without any word
    assert mixed(awkward.limit(0), max_repetition=2.0) == []


def test_either_target_is_needed(corpus):
    with pytest.raises(ValueError):
        mixing.mix_sources(corpus)


def test_rows_without_ids_are_ordered_by_their_texts(spark):
    rows = [(None, f"word{i} " * 10, "a") for i in range(6)] + [(i, f"other{i} " * 10, "b") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = mixing.mix_sources(docs, target_entropy=1.0).where("doc_id IS NULL").collect()
    assert sum(r.copies for r in mixed) == 18  # half of 36 texts of ten words
    half = mixing.mix_sources(docs, target_entropy=1.0, budget=60).where("doc_id IS NULL").collect()
    assert sorted(r.copies for r in half) == [0, 0, 0, 1, 1, 1]


def test_any_column_names(spark):
    names = ["rest", "blocks", "passes", "last_block", "last_order", "_name", "_source", "_order", "copy", "a.b", "weight"]
    docs = spark.createDataFrame([(i, "some words", f"s{i % 2}", *names) for i in range(4)],
                                 ["doc_id", "text", "source", *names])
    mixed = mixing.mix_sources(docs, max_repetition=2.0)
    kept = [c for c in docs.columns if c != "weight"]
    assert mixed.columns == [*kept, *mixing.ADDED]
    for row in mixing.realise(mixed).collect():
        assert list(row[3:]) == names[:-1]
