"""Small documents with every awkward case the operators define."""

from __future__ import annotations

import random

import pytest
from hypothesis import settings

settings.register_profile("steady", deadline=None)  # the first example loads modules and tables
settings.load_profile("steady")

LONG = " ".join(f"w{i % 977}" for i in range(60_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, equal texts, clashing column names."""
    rows = [
        (1, None, "a", 7), (2, "", "a", 7), (3, " \n\t ", None, 7), (None, "some words here", "a", 7),
        (None, None, None, None), (4, "tie " * 20, "b", 7), (5, "tie " * 20, "b", 7), (5, "tie " * 20, "b", 7),
        (6, LONG, "b", 7), (7, "x", "c", 7), (8, "é ▁日本🤖 <s>\x00", "c", None), (8, "another text of one id", "c", 1),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_words bigint").repartition(3)


@pytest.fixture(scope="session")
def corpus(spark):
    """Random documents with exact copies, near copies and shared passages."""
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(400)] + ["the", "of", "and"] * 30
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts: list[str] = []
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        if i % 5 == 0:
            words[len(words) // 2 : len(words) // 2] = passage
        if i % 7 == 1:
            words = texts[rng.randrange(len(texts))].split()
        if i % 7 == 2:
            words = texts[rng.randrange(len(texts))].split()
            words[rng.randrange(len(words))] = "changed"
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    rows = [(i, t, f"s{i % 4 if i % 3 else 0}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
