import random

from hypothesis import given
from hypothesis import strategies as st

from orderlake.llm import license_scan as s

KNOWN = s.templates()
GPL = ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.")
CC_BY = ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.")
assert {GPL, CC_BY} <= set(s.TEMPLATES)


def brute(text, template, coverage):
    """Best coverage over the same windows, without any bound that leaves windows out."""
    found, size = s.words(text), len(template.words)
    best = 0.0
    for a in range(0, max(1, len(found) - size), max(1, size // 2)):
        pairs = [(a + i, j) for i, j in s.align(found[a : a + 2 * size], list(template.words))]
        if pairs and template.accepts(found, pairs):
            best = max(best, len(pairs) / size)
    return best if best >= coverage - 1e-9 else None


def longest_common(text, template):
    """Length of the longest common subsequence within any stretch of one and a half template lengths, by a table."""
    best = 0
    span = int(s.SPAN * len(template))
    for a in range(max(1, len(text) - span + 1)):
        row = [0] * (len(template) + 1)
        for w in text[a : a + span]:
            row, old = [0], row
            for j, t in enumerate(template):
                row.append(old[j] + 1 if w == t else max(old[j + 1], row[j]))
        best = max(best, row[-1])
    return best


@given(st.lists(st.sampled_from("abcde"), max_size=12), st.lists(st.sampled_from("abcde"), max_size=8))
def test_alignments_rise_and_match(text, template):
    pairs = s.align(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:], strict=False))


@given(st.lists(st.integers(0, 30), max_size=20, unique=True))
def test_longest_rising_run(numbers):
    got = s._rising(list(enumerate(numbers)))
    best = [1] * len(numbers)
    for i, x in enumerate(numbers):
        best[i] = max([1, *(best[j] + 1 for j in range(i) if numbers[j] < x)])
    assert len(got) == max(best, default=0)
    assert all(a[1] < b[1] for a, b in zip(got, got[1:], strict=False))


def test_notices_are_found_wherever_they_stand():
    filler = " ".join(f"word{i}" for i in range(500))
    for name, notice in s.TEMPLATES:
        for text in (notice, f"{filler}\n{notice}", f"{notice}\n{filler}", f"{filler} {notice} {filler}", notice.upper()):
            license_, coverage, begin, end, names = s.scan_text(text, KNOWN, 0.8)
            assert (license_, coverage, names) == (name, 1.0, [name])
            assert s.words(text)[begin:end] == s.words(notice)


def test_changed_notices_and_clean_texts():
    changed = "This work is licensed under the GNU Lesser Public License, version 3."
    assert s.scan_text(changed, KNOWN, 0.8)[0] == "LGPL-3.0"
    assert s.scan_text(changed, KNOWN, 0.99)[0] is None
    scattered = " and ".join("Licensed under the Apache License Version".split()) + " or more words " * 20
    for text in (None, "", "the version of the license under which nothing is said", scattered, "under the of " * 3000):
        assert s.scan_text(text, KNOWN, 0.8) == (None, 0.0, None, None, [])


def test_two_notices():
    text = "Released under the MIT License. Some words between. Licensed under CC BY-NC 4.0."
    assert s.scan_text(text, KNOWN, 0.8)[4] == ["CC-BY-NC-4.0", "MIT"]


def test_bounds_leave_no_window_out(corpus):
    notice = GPL[1]
    for row in corpus.limit(40).collect():
        text = f"{row.text} {notice[: 10 + row.doc_id]} {row.text}"
        for template in KNOWN:
            found = s.words(text)
            hit = s.find(found, set(found), template, 0.6)
            assert (hit[0] if hit else None) == brute(text, template, 0.6)


def test_frames(awkward):
    out = s.scan_licenses(awkward.withColumnRenamed("source", "license"))
    assert out.count() == awkward.count() and out.where("license IS NOT NULL").count() == 0
    assert s.scan_licenses(awkward.limit(0)).count() == 0


def test_words_of_a_notice_at_the_ends_of_its_window():
    filler = "This repository holds small example scripts for teaching young people to write programs well."
    for name, notice in s.TEMPLATES:
        first, last = notice.split()[0], notice.split()[-1]
        for n in range(2 * len(notice.split())):
            words = " ".join(f"word{i}" for i in range(n))
            for text in (f"{first} {words} {notice}", f"{notice} {words} {last}", f"{first} {words} {notice} {words} {last}"):
                assert s.scan_text(text, KNOWN, 0.8)[:2] == (name, 1.0)
    for notice in (GPL, CC_BY):
        assert s.scan_text(f"{filler} {notice[1]}", KNOWN, 0.8)[:2] == (notice[0], 1.0)
        changed = notice[1].replace("This work", "Our work")
        license_, coverage, begin, end, _ = s.scan_text(f"{filler} {changed}", KNOWN, 0.8)
        assert license_ == notice[0] and coverage > 0.9 and end - begin == len(s.words(changed)) - 1
    assert s.scan_text(f"{GPL[1]} {GPL[1]}", KNOWN, 0.8)[0] == "GPL-3.0"


def test_one_coverage_at_every_position():
    rng = random.Random(2)
    for name, notice in s.TEMPLATES:
        parts = notice.split()
        if len(parts) < 20:
            continue
        telling = [i for i, w in enumerate(parts) if s._telling(s.words(w))]
        spare = [i for i in range(1, len(parts) - 1) if i not in telling]
        missing = set(rng.sample(spare, len(parts) // 8))
        cut = " ".join(w for i, w in enumerate(parts) if i not in missing)
        stretched = " ".join(w + (" filling" if i in missing else "") for i, w in enumerate(parts))
        for text, least in ((notice, 1.0), (cut, 0.8), (stretched, 0.95)):
            seen = {s.scan_text(" ".join(f"word{i}" for i in range(n)) + f" {text} " + "end " * 40, KNOWN, 0.8)[:2] for n in range(90)}
            assert len(seen) == 1, (name, seen)
            ((license_, coverage),) = seen
            assert license_ == name and coverage >= least


def test_alignment_reaches_the_longest_common_words():
    """Patience is no longest common subsequence, but on notices with some words changed it finds as much."""
    rng = random.Random(5)
    for name, notice in s.TEMPLATES:
        template = s.words(notice)
        if len(template) < 10:
            continue
        for _ in range(5):
            text = [w if rng.random() > 0.1 else b"changed%d" % rng.randrange(99) for w in template]
            text = [b"w%d" % i for i in range(rng.randrange(5))] + text + [b"v%d" % i for i in range(rng.randrange(5))]
            pairs = s.align(text, template)
            assert len(pairs) >= 0.9 * longest_common(text, template), (name, text)


def test_relatives_keep_their_names():
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    cases = {
        gnu.format("", "2"): "GPL-2.0", gnu.format("", "3"): "GPL-3.0", gnu.format("Lesser ", "3"): "LGPL-3.0",
        gnu.format("Lesser ", "2.1"): "LGPL-2.1", gnu.format("Affero ", "3"): "AGPL-3.0", gnu.format("", "4"): None,
        gnu.format("", "3").removesuffix("3.") + "1": None, gnu.format("Library ", "2"): None,
        cc.format(""): "CC-BY-4.0", cc.format("-NonCommercial"): "CC-BY-NC-4.0", cc.format("-ShareAlike"): "CC-BY-SA-4.0",
        cc.format(" NonCommercial"): None, cc.format("-NonCommercial-NoDerivatives"): "CC-BY-NC-ND-4.0",
        cc.replace("4.0", "3.0").format(""): None, "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under the MIT-0 License.": "MIT-0",
        "Not licensed under the MIT License.": None, "It is not released under the MIT License.": None,
        "Licensed under the BSD 2-Clause License.": "BSD-2-Clause", "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
        "Licensed under the Apache License, Version 1.1.": None, "Licensed under the ISC License.": "ISC",
    }
    for text, name in cases.items():
        for around in ("{}", "word {} word", "Copyright 2020 somebody\n{}\nthe end of it"):
            assert s.scan_text(around.format(text), KNOWN, 0.8)[0] == name, text


def test_any_column_names(spark):
    docs = spark.createDataFrame([("Licensed under the MIT License.", "x", "y")], ["a.text", "a.b", "licenses"])
    row = s.scan_licenses(docs, text_col="a.text").first()
    assert row.license == "MIT" and row["a.b"] == "x"
