"""License notices in texts, by patience alignment with templates.

Words that occur once in a stretch of text and once in the template are anchors; the longest run of anchors in the
same order (a longest increasing subsequence) is kept, and the gaps between them are aligned in the same way, after
equal words at their ends. The ends of a window are no such ends, as a notice may begin anywhere in it; they are tried too,
as words that occur twice are no anchors. Where aligned words spread too far, the densest run of them is aligned anew.
A check for the notice word for word follows where words were left over. Coverage is the share of the template's words
that were aligned. A notice may stand anywhere in a text, so windows of twice the template's length are aligned, each half
a length after the one before.

Windows that cannot reach the coverage are left out first: it is never more than the share of template words that
occur there at all. That bound loses nothing. Each task reads its texts once; nothing is shuffled.

A notice is found if its coverage is enough, its aligned words lie within one and a half times its length, more than half
of the words that no other license's template has were aligned (notices share most of their other words), and the words
that tell related licenses apart are the template's: every number and kind (lesser, affero, noncommercial, ..) of it is
aligned, and no other stands among its words. What is denied by a word before it is no notice.

Words are compared lowered (A-Z) and without punctuation. Null or empty text: no notice. Existing columns of the added
names are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderlake.llm.frames import appended

# Notices of public licenses, by SPDX name; several wordings of one license may be listed.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("MIT-0", "Licensed under the MIT-0 License."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the "
                   "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal dedication."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
                     "License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                        "International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                        "International License."),
)
# Words that tell a license from its relatives, also as parts of hyphenated words. So do numbers.
KINDS = frozenset(
    b"mit isc apache gnu lesser library affero bsd clause mozilla cc cc0 by nc sa nd noncommercial sharealike "
    b"noderivatives noderivs international universal not never".split()
)
NEGATIONS = frozenset((b"not", b"never"))
SPAN = 1.5  # aligned words lie within so many lengths of the template
ADDED = "license string, license_coverage double, license_start bigint, license_end bigint, licenses array<string>"

_PUNCTUATION = bytes.maketrans(b".,;:()[]{}\"'!?*#<>|", b" " * 19)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_PUNCTUATION).split()


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs, sorted by the first number, whose second number rises; by patience piles."""
    tops: list[int] = []
    on: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(on[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            on.append(i)
        else:
            tops[pile], on[pile] = b, i
    out, at = [], on[-1] if on else -1
    while at >= 0:
        out.append(pairs[at])
        at = back[at]
    return out[::-1]


def _patience(text: list[bytes], template: list[bytes], ends: bool) -> list[tuple[int, int]]:
    """Aligned places; equal words at the ends of the whole text are matched only with ``ends``."""
    out: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        left, right = ends or a > 0, ends or b < len(text)
        while left and a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while right and a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {template[j]: j for j in range(c, d) if there[template[j]] == 1}
        anchors = _rising([(i, place[text[i]]) for i in range(a, b) if here[text[i]] == 1 and text[i] in place])
        if not anchors:
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)], strict=True):
            work.append((i + 1, k, j + 1, m))
    return sorted(out)


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places (in the text, in the template), in order: the most that lie within the span of a notice."""
    size = len(template)
    best: list[tuple[int, int]] = []
    for ends in (False, True):
        pairs = _patience(text, template, ends)
        if pairs and pairs[-1][0] - pairs[0][0] >= SPAN * size:
            runs = [[q for q in pairs[i:] if q[0] - p[0] < SPAN * size] for i, p in enumerate(pairs)]
            pairs = max(runs, key=len)
            low, high = pairs[0][0], pairs[-1][0] + 1
            again = [(low + i, j) for i, j in _patience(text[low:high], template, True)]
            pairs = max(pairs, again, key=len)
        best = max(best, pairs, key=len)
    if len(best) < size:  # words that stand there twice are no anchors; a notice word for word is found all the same
        for i in range(len(text) - size + 1):
            if text[i : i + size] == template:
                return [(i + j, j) for j in range(size)]
    return best


def _telling(words: Iterable[bytes]) -> Counter:
    """The kinds and numbers in words, and how often."""
    return Counter(p for w in words for p in w.split(b"-") if p in KINDS or p.isdigit())


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[bytes, ...]
    counts: dict
    own: frozenset  # words that templates of other names do not have
    telling: Counter

    def accepts(self, text: list[bytes], pairs: list[tuple[int, int]]) -> bool:
        """Whether aligned places are close together and name this license and no relative of it.

        All kinds and numbers of the template are aligned, no other is among the words from the first to the last place,
        and none of the three words before denies the notice.
        """
        first, last = pairs[0][0], pairs[-1][0]
        if last - first >= SPAN * len(self.words) or not NEGATIONS.isdisjoint(text[max(0, first - 3) : first]):
            return False
        # The first and last words of a notice may be missing, so a number or kind right beside it counts as well.
        edges = [w for w in text[max(0, first - 1) : first] if pairs[0][1] > 0]
        edges += [w for w in text[last + 1 : last + 2] if pairs[-1][1] < len(self.words) - 1]
        if _telling(self.words[j] for _, j in pairs) != self.telling:
            return False
        if _telling([*text[first : last + 1], *edges]) != self.telling:
            return False
        named = {self.words[j] for _, j in pairs} & self.own
        return 2 * len(named) > len(self.own) or not self.own


def templates(texts=TEMPLATES) -> list[Template]:
    split = [(name, tuple(words(text))) for name, text in texts]
    return [
        Template(
            name, own, dict(Counter(own)), frozenset(own).difference(*[w for n, w in split if n != name]), _telling(own)
        )
        for name, own in split
    ]


def find(text: list[bytes], present: set[bytes], template: Template, coverage: float) -> tuple | None:
    """Best (coverage, first word, word after the last) of a template in a text, the earliest of equals."""
    size = len(template.words)
    need = coverage * size - 1e-9
    if sum(n for w, n in template.counts.items() if w in present) < need:
        return None
    known = np.zeros(len(text) + 1, dtype=np.int64)
    np.cumsum(np.fromiter((w in template.counts for w in text), dtype=bool, count=len(text)), out=known[1:])
    # A notice spans at most one and a half lengths: half a length on, the next window holds what this one cuts.
    begins = np.arange(0, max(1, len(text) - size), max(1, size // 2))
    ends = np.minimum(begins + 2 * size, len(text))
    best = None
    for a in begins[known[ends] - known[begins] >= need].tolist():
        part = text[a : a + 2 * size]
        if sum(min(n, template.counts.get(w, 0)) for w, n in Counter(part).items()) < need:
            continue
        pairs = align(part, list(template.words))
        if len(pairs) < need or best and len(pairs) <= best[0]:
            continue
        pairs = [(a + i, j) for i, j in pairs]
        if template.accepts(text, pairs):
            best = (len(pairs), pairs[0][0], pairs[-1][0] + 1)
    return None if best is None else (best[0] / size, best[1], best[2])


def scan_text(text: str | None, known: list[Template], coverage: float) -> tuple:
    """(license, coverage, first word, word after the last, all licenses) of a text.

    Better coverage goes first, then the longer template, then the first listed. A notice of another license that lies
    in words already taken is left out: notices share most of their words.
    """
    found = words(text)
    present = set(found)
    hits = []
    for rank, template in enumerate(known):
        hit = find(found, present, template, coverage)
        if hit:
            hits.append(((-hit[0], -len(template.words), rank), template.name, hit))
    if not hits:
        return None, 0.0, None, None, []
    taken: list[tuple[str, tuple]] = []
    for _, name, hit in sorted(hits):
        if all(name == other or hit[2] <= t[1] or t[2] <= hit[1] for other, t in taken):
            taken.append((name, hit))
    name, hit = taken[0]
    return name, hit[0], hit[1], hit[2], sorted({n for n, _ in taken})


def scan_licenses(
    df: DataFrame, text_col: str = "text", coverage: float = 0.8, texts: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """``df`` with the best notice of each text, where it stands (in words), and all licenses found."""
    types = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.string())]

    def compute(column: pa.Array) -> list[pa.Array]:
        known = templates(texts)
        rows = [scan_text(t, known, coverage) for t in column.to_pylist()]
        return [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]

    return appended(df, [text_col], compute, ADDED, sliced=True)
