import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from orderlake.llm import text as t

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x1c\xa0aé日B", max_size=20)), max_size=8))
def test_words_are_those_of_each_text(texts):
    column = pa.array(texts, pa.string())
    words = t.words_of(column)
    got = [
        [words.data[a:b].tobytes() for a, b in zip(words.starts[i:j], words.ends[i:j], strict=True)]
        for i, j in zip(words.first, words.first[1:], strict=False)
    ]
    assert got == [WORD.findall((x or "").encode()) for x in texts]


def test_equal_words_have_equal_hashes_anywhere():
    long = "x" * 9000
    column = pa.array([f"alpha {long} beta " * 40, f"beta alpha {long}", "ALPHA"] * 30)
    words = t.words_of(column.slice(1))
    names = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
    by_name: dict = {}
    for name, h in zip(names, words.hashes.tolist(), strict=True):
        by_name.setdefault(name, set()).add(h)
    assert all(len(h) == 1 for h in by_name.values()) and len({min(h) for h in by_name.values()}) == len(by_name)


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"id": list(range(50)), "text": ["x" * (i * 7 % 40) for i in range(50)]})
    parts = list(t.slices(iter([batch, batch.slice(0, 0)]), "text", 60))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(50)) and len(parts) > 5


@given(st.lists(st.integers(0, 99), min_size=1, max_size=30), st.integers(1, 9))
def test_sliding_minimum(values, width):
    if width <= len(values):
        expected = [min(values[i : i + width]) for i in range(len(values) - width + 1)]
        assert t.sliding_min(np.array(values), width).tolist() == expected
