import re

from pyspark.sql import functions as F

from orderlake.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in q.SYMBOLS for c in text), "n_exclaims": text.count("!"),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


TEXTS = [
    "a b c a b c a", "x x x x x", "one\ntwo\n\none\n \n", "#a $b | c!", "\t\x0b\x0c mixed\r\nlines\r\n", "é ê|| 日本",
    "a b c d a b c d e", "a b a b a", "w", "a b", "no repeats here at all", "\n", "l1\nl1\nl1\nl1",
]


def test_measures_equal_plain_python(spark, awkward):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    for docs in (frame, awkward):
        rows = q.ledger(docs).collect()
        assert len(rows) == docs.count()
        for row in rows:
            expected = measures(row.text)
            assert {m: row[m] for m in q.MEASURES} == expected, row.text[:80]
    assert q.ledger(awkward.limit(0)).count() == 0


def test_no_python_and_no_shuffle(awkward):
    fresh = awkward.select("*")  # a plan of its own: the shared frame's has run and shows its stages
    plan = q.judge(q.ledger(fresh))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.count("Exchange") == fresh._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_a_filter_on_the_verdict_computes_nothing_again(awkward):
    kept = q.judge(q.ledger(awkward)).where("kept AND n_words > 60").select("doc_id", "text")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    for call in ("regexp_extract_all(", "sort_array(", "array_distinct("):
        assert plan.count(call) <= 2, call  # the words once; windows and places are sorted


def test_policies_read_the_same_ledger(spark):
    bits = [0, 1, 2, 3, 4, 12, 32]
    book = spark.createDataFrame([(b,) for b in bits], "failures int")
    standard = {r.failures: r.kept for r in q.judge(book).collect()}
    base = {r.failures: r.kept for r in q.judge(book, q.BASE).collect()}
    assert [b for b in bits if standard[b]] == [0]
    assert [b for b in bits if base[b]] == [0, 4, 12, 32]
    assert {r.policy_version for r in q.judge(book, q.BASE).collect()} == {"base"}


def test_ablations(spark):
    book = spark.createDataFrame([(b,) for b in (0, 1, 1, 3, 4, 5)], "failures int")
    got = {r.rule: (r.n_failed, r.n_only, r.n_rejected) for r in q.ablations(book).collect()}
    assert got["too_few_words"] == (4, 2, 5)
    assert got["repeated_windows"] == (1, 0, 5)
    assert got["many_symbols"] == (2, 1, 5)
    assert got["many_exclaims"] == (0, 0, 5)


def test_clean_text_is_kept_and_junk_is_not(spark):
    clean = " ".join(f"word{i}" for i in range(80)) + "."
    junk = " ".join(f"word{i}%%%" for i in range(80))
    shout = " ".join(f"WORD{i}!!" for i in range(80))
    doubled = "\n".join(["the same line of text again"] * 20)
    frame = spark.createDataFrame([(clean,), (junk,), (shout,), (doubled,)], "text string")
    rows = q.judge(q.ledger(frame)).select("kept", F.col("failures")).collect()
    assert [r.kept for r in rows] == [True, False, False, False]


def test_any_column_names(spark):
    names = ["_words", "_lines", "_windows", "_places", "a.b", "failures"]
    docs = spark.createDataFrame([(1, "some words", *names)], ["doc_id", "text", *names])
    row = q.ledger(docs).first()
    assert list(row[2:7]) == names[:-1] and row.n_words == 2
