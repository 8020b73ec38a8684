import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm.substring_dedup import SuffixAutomaton, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """{(id, text): (words, removed, kept text)} by comparing every window with every document."""
    first = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = {
            i + j
            for i in range(len(words) - window + 1)
            if doc is not None and first[tuple(words[i : i + window])] < doc
            for j in range(window)
        }
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc, text] = (len(words), len(gone), kept)
    return out


def found(frame, window, **options):
    rows = remove_repeats(frame, window=window, **options).collect()
    return [((r.doc_id, r.text), (r.n_words, r.n_removed, r.kept_text)) for r in rows]


def test_equals_comparing_every_window(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    for window, hot in ((13, 5000), (5, 5000), (7, 2)):
        expected = brute(rows, window)
        got = found(corpus, window, hot=hot)
        assert len(got) == len(rows) and dict(got) == expected
        assert sum(x[1] for x in expected.values()) > 500


def test_awkward_rows(awkward, spark):
    got = found(awkward, 13)
    expected = brute([(r.doc_id, r.text) for r in awkward.collect()], 13)
    assert len(got) == awkward.count() and dict(got) == expected
    assert remove_repeats(awkward).columns == ["doc_id", "text", "source", "n_words", "n_removed", "kept_text"]
    assert remove_repeats(awkward.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 5))
def test_automaton_gives_the_first_document_of_each_window(texts, window):
    automaton = SuffixAutomaton()
    for doc, words in enumerate(texts):
        automaton.add(words, doc)
    automaton.finish()
    first = {}
    for doc, words in enumerate(texts):
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), doc)
    for probe in [*texts, list("abcabcaab")]:
        expected = [first.get(tuple(probe[i : i + window])) for i in range(len(probe) - window + 1)]
        assert automaton.first_documents(probe, window) == expected


def test_random_words_keep_their_digest(spark):
    words = [str(random.Random(1).random()) for _ in range(30)]
    frame = spark.createDataFrame([(1, "\t".join(words))], "doc_id bigint, text string")
    kept = remove_repeats(frame).first().kept_text
    assert hashlib.sha256(kept.encode()).hexdigest() == hashlib.sha256(" ".join(words).encode()).hexdigest()
