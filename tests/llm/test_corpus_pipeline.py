"""The registered queries against SQL, and each stage of the pipeline against a plain version on its own input."""

import os

import duckdb
import pytest

import corpus_pipeline as pipeline
from orderlake.llm.queries import ORACLE_SQL, PIECE_MODEL, QUERIES
from orderlake.llm.token_counts import count_text
from tests.llm.test_prob_minhash import classes
from tests.llm.test_quality_rules import measures
from tests.llm.test_substring_dedup import brute
from tools.check_oracle import compare_ready

TABLES = os.environ.get("ORDERLAKE_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        duck.execute(f"create view {table} as select * from '{TABLES}/{table}.parquet'")
    frame = QUERIES[name](spark, TABLES)
    result = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    rows = frame.collect()
    assert rows and compare_ready(frame.columns, rows) == compare_ready(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_gives_a_row_per_document(spark, name):
    assert QUERIES[name](spark, TABLES).count() == spark.read.parquet(f"{TABLES}/documents.parquet").count()


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    outputs = {}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, TABLES).write.parquet(f"{tmp_path}/{i}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == columns or name == "tokenise"
        outputs[name] = docs.collect()

    def failing(text):
        m = measures(text)
        return (
            m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
            or 4 * m["n_exclaims"] > m["n_words"] or (m["n_dup_lines"] >= 3 and 100 * m["n_dup_lines"] > 30 * m["n_lines"])
            or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"]
        )

    kept = {d: r for d, r in before.items() if not failing(r.text)}
    assert {r.doc_id: r for r in outputs["quality_rules"]} == kept
    first = classes([(d, r.text) for d, r in sorted(kept.items())])
    kept = {d: r for d, r in kept.items() if first[d] == d}
    assert {r.doc_id: r for r in outputs["near_dedup"]} == kept
    cut = brute([(d, r.text) for d, r in kept.items()], 13)
    expected = {}
    for d, r in kept.items():
        n, gone, text = cut[d, r.text]
        if not gone:
            expected[d] = (r.text, r.n_chars)
        elif gone < n:
            expected[d] = (text, len(text))
    assert {r.doc_id: (r.text, r.n_chars) for r in outputs["substring_dedup"]} == expected
    assert {r.doc_id: r.text for r in outputs["mix"]} == {d: text for d, (text, _) in expected.items()}
    assert len(outputs["mix"]) == len(outputs["tokenise"]) >= len(expected)
    for r in outputs["tokenise"]:
        assert r.n_tokens == len(r.piece_ids) == count_text(expected[r.doc_id][0], PIECE_MODEL)
    assert pipeline.run(spark, TABLES).count() == len(outputs["tokenise"])


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_stages_take_awkward_rows(spark, awkward, stage):
    docs = awkward.selectExpr("doc_id", "text", "cast(null AS string) AS lang", "source", "cast(1 AS bigint) AS n_chars")
    for frame in (docs, docs.limit(0)):
        stage(spark, frame, TABLES).collect()


def test_texts_of_a_repeated_id_are_judged_by_themselves(spark):
    import random

    rng = random.Random(8)
    texts = {name: [f"{name}{rng.randrange(900)}" for _ in range(120)] for name in "ABCD"}
    near = [*texts["A"][:-1], "else"]
    rows = [(3, "B"), (7, "A"), (7, "B"), (9, "near A"), (20, "C"), (20, "D"), (None, "C"), (None, "C"), (4, None), (4, None)]
    words = {**texts, "near A": near}
    docs = spark.createDataFrame(
        [(i, " ".join(words[t]) if t else None, "s", t) for i, t in rows], "doc_id bigint, text string, `row` string, name string"
    )
    kept = pipeline.near_dedup(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.name) for r in kept.collect()), key=str)
    expected = [(3, "B"), (7, "A"), (20, "C"), (20, "D"), (None, "C"), (None, "C"), (4, None), (4, None)]
    assert got == sorted(expected, key=str)
