import random

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from orderlake.llm import piece_codec as codec
from orderlake.llm.piece_codec import decode, decode_ids, encode, encode_text
from orderlake.llm.queries import PIECE_MODEL
from orderlake.llm.token_counts import count_text, count_tokens


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def samples():
    rng = random.Random(9)
    letters = "ab  ▁the\n\tzé日🤖①\x00 <0x41>xx  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return [*texts, "", " ", " " * 200 + "x", "a" * 5000, "▁" * 33, "word " * 2000]


def test_ids_text_and_counts_equal_the_library(library):
    for text in samples():
        ids = library.encode(text)
        assert encode_text(text, PIECE_MODEL) == ids
        assert decode_ids(ids, PIECE_MODEL) == library.decode(ids)
        assert count_text(text, PIECE_MODEL) == len(ids)


def test_foreign_ids_decode_like_the_library(library):
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.randrange(3, 400) for _ in range(rng.randint(0, 12))]
        assert decode_ids(ids, PIECE_MODEL) == library.decode(ids)
        column = pa.array([ids], pa.list_(pa.int32()))
        assert codec.decode_column(column, PIECE_MODEL).to_pylist() == [library.decode(ids)]


def test_frames(awkward, library):
    coded = decode(encode(awkward, PIECE_MODEL), PIECE_MODEL).collect()
    assert len(coded) == awkward.count()
    for row in coded:
        assert row.piece_ids == library.encode(row.text or "")
        assert row.decoded == library.decode(row.piece_ids)
    assert encode(awkward.limit(0), PIECE_MODEL).count() == 0


def test_counts_of_frames(awkward, library):
    clashing = awkward.withColumn("n_tokens", F.lit("old"))
    rows = count_tokens(clashing, PIECE_MODEL, limit=10).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        n = len(library.encode(row.text or ""))
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (n, len((row.text or "").encode()), n > 10)


CHARS = [" ", "  ", "▁", "a", "the", "é", "日本", "🤖", "\n", "\t", "<s>", "\x00", "ing", "‍", "ﬁ", "x" * 70, "ab" * 40]


def test_columns_equal_the_library():
    rng = random.Random(1)
    texts = [None, "", " ", "  ", "▁", "a ", " a", "a  b", "\n" * 100 + "é" * 70]
    texts += ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    expected = [library.encode(t or "") for t in texts]
    column = pa.array(texts, pa.string())
    ids = codec.encode_column(column, PIECE_MODEL)
    assert ids.to_pylist() == expected
    decoded = codec.decode_column(ids, PIECE_MODEL).to_pylist()
    assert decoded == [library.decode(x) for x in expected]
    # Also of columns that are parts of others, as batches are.
    assert codec.encode_column(column.slice(5, 300), PIECE_MODEL).to_pylist() == expected[5:305]
    assert codec.decode_column(ids.slice(7, 300), PIECE_MODEL).to_pylist() == decoded[7:307]
    assert codec.encode_column(pa.array([], pa.string()), PIECE_MODEL).to_pylist() == []
    assert codec.decode_column(pa.array([None, []], pa.list_(pa.int32())), PIECE_MODEL).to_pylist() == ["", ""]


def test_each_distinct_chunk_is_segmented_once(monkeypatch):
    asked = []
    plain = codec.segment_all
    monkeypatch.setattr(codec, "segment_all", lambda names, path: asked.append(names) or plain(names, path))
    codec.encode_column(pa.array(["one two one", "two  one", "one\n two"]), PIECE_MODEL)
    assert len(asked) == 1 and sorted(asked[0]) == sorted(["one", "two", "▁▁one", "one\n"])


def test_any_column_names(spark):
    docs = spark.createDataFrame([("some words", "x", [1])], "`a.text` string, `a.b` string, Piece_Ids array<int>")
    row = codec.decode(codec.encode(docs, PIECE_MODEL, text_col="a.text"), PIECE_MODEL).first()
    assert row["a.b"] == "x" and row.decoded == "some words" and len(row.piece_ids) == 2
