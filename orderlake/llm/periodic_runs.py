"""Runs of periodic words in whole texts, and the texts without the repetitions.

A run is a stretch of words with smallest period ``q``, at least ``exponent * q`` and ``shortest`` words long, that no
neighbouring word extends. Words equal to those ``q`` further on then form a stretch of ``max(shortest, exponent * q) - q``
words and more, so a grid of that step meets every such stretch: the grids of all periods of a text have about
``n log n / 3`` places. Places whose word differs from that one period on, or whose few words around end on both sides,
are done; for the texts that are left, longest common extensions forwards and backwards by a difference cover
(``lce.Extensions``) give the whole stretch. A stretch found at several periods is a run of the smallest.

All grids of a batch of texts are handled at once in numpy, inside Spark tasks; nothing is shuffled. Words are compared
by 64-bit hashes.

Null, empty and blank texts: no runs, empty collapsed text. Columns of the added names are replaced; others, whatever
their names, and repeated rows are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import appended
from orderlake.llm.lce import Extensions
from orderlake.llm.text import words_of

RUN = "struct<start: bigint, length: bigint, period: bigint>"
ADDED = f"n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed_text string"

_FEW = 8  # words compared on each side before a text is indexed
_AT_ONCE = 1 << 20  # grid places handled at once


def _extent(words: np.ndarray, a: np.ndarray, b: np.ndarray, stop: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal words next to places ``a`` and ``b`` in a direction, at most a few; whether they end there.

    ``stop``: the place that the leading one of the two must not reach.
    """
    out = np.zeros(len(a), dtype=np.int64)
    going = np.arange(len(a))
    lead = b if step > 0 else a
    for k in range(1, _FEW + 1):
        going = going[lead[going] + step * k != stop[going]]
        going = going[words[a[going] + step * k] == words[b[going] + step * k]]
        out[going] = k
    ended = np.ones(len(a), dtype=bool)
    ended[going] = False
    return out, ended


def _grid(first: np.ndarray, exponent: int, shortest: int):
    """Places of the grids of all periods of all texts: (text, period, place), some at a time."""
    n = np.diff(first)
    periods = np.where(n >= shortest, n // exponent, 0)
    text = np.repeat(np.arange(len(n)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(shortest, exponent * period) - period
    count = (n[text] - period) // step
    upto = np.cumsum(count)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] - count[at] + _AT_ONCE, side="right")))
        c = count[at:to]
        row = np.repeat(np.arange(at, to), c)
        k = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
        yield text[row], period[row], first[text[row]] + step[row] * (k + 1) - 1
        at = to


def _indexed(words: np.ndarray, first: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts as small numbers, with separators around; where in it each text is, less where it was."""
    lengths = first[texts + 1] - first[texts]
    begin = np.cumsum(lengths + 1) - lengths
    sequence = np.empty(int(lengths.sum()) + len(texts) + 1, dtype=np.int64)
    inside = np.ones(len(sequence), dtype=bool)
    inside[begin - 1] = inside[-1] = False
    source = np.repeat(first[texts] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    names, numbers = np.unique(words[source], return_inverse=True)
    sequence[inside] = numbers
    sequence[~inside] = len(names) + np.arange(len(texts) + 1)
    return sequence, begin - first[texts]


def runs_of(
    words: np.ndarray, first: np.ndarray, exponent: int = 4, shortest: int = 6
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, in this order; ``first[i]:first[i + 1]`` are the words of text i."""
    found: list[np.ndarray] = []
    open_: list[np.ndarray] = []
    for text, period, place in _grid(first, exponent, shortest):
        equal = words[place] == words[place + period]
        text, period, place = text[equal], period[equal], place[equal]
        after, ends = _extent(words, place, place + period, first[text + 1], 1)
        before, begins = _extent(words, place, place + period, first[text] - 1, -1)
        done = ends & begins
        long = before + 1 + after >= np.maximum(shortest, exponent * period) - period
        rows = np.stack([text, period, place - before, place + after + 1])
        found.append(rows[:, done & long])
        open_.append(np.stack([text, period, place])[:, ~done])
    text, period, place = np.concatenate(open_, axis=1) if open_ else np.zeros((3, 0), dtype=np.int64)
    if len(text):
        texts, number = np.unique(text, return_inverse=True)
        sequence, moved = _indexed(words, first, texts)
        a = place + moved[number]
        after = Extensions(sequence).of(a, a + period)
        last = len(sequence)
        before = Extensions(sequence[::-1]).of(last - a, last - a - period)
        rows = np.stack([text, period, place - before, place + after])
        found.append(rows[:, before + after >= np.maximum(shortest, exponent * period) - period])
    text, period, start, stop = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
    length = stop - start + period
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    same = (text[1:] == text[:-1]) & (start[1:] == start[:-1]) & (length[1:] == length[:-1])
    kept = np.append(True, ~same)[: len(text)]
    text, start, length, period = text[kept], start[kept] - first[text[kept]], length[kept], period[kept]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _strongest(text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Row of the greatest length / period of each text with runs; ties: smallest start, then period.

    Quotients of numbers below 2^26 differ as doubles if they differ at all.
    """
    order = np.lexsort((period, start, -(length / period), text))
    return order[np.append(True, text[order][1:] != text[order][:-1])[: len(order)]]


def _collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    if not len(start):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def find_runs(docs: DataFrame, text_col: str = "text", exponent: int = 4, shortest: int = 6) -> DataFrame:
    """``docs`` with ``n_words``, the ``runs`` of words, the ``strongest`` run and the ``collapsed_text``.

    Runs are in the order of their starts, then periods; the strongest has the greatest length by period. The collapsed
    text has every word but those that a run holds after its first period, joined by one space.
    """
    if exponent < 2 or shortest < 2:
        raise ValueError("a run repeats its period, so exponent and shortest are at least 2")

    def compute(texts: pa.Array) -> list[pa.Array]:
        words = words_of(texts)
        text, start, length, period = runs_of(words.hashes, words.first, exponent, shortest)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        collapsed = [
            _collapse((t or "").encode().split(), start[a:b], length[a:b], period[a:b]).decode()
            for t, a, b in zip(texts.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        names = ["start", "length", "period"]
        runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names)
        best = np.full(len(texts), -1)
        row = _strongest(text, start, length, period)
        best[text[row]] = row
        strongest = runs.take(pa.array(best, mask=best < 0))
        return [
            pa.array(np.diff(words.first)),
            pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), runs),
            strongest,
            pa.array(collapsed, pa.string()),
        ]

    return appended(docs, [text_col], compute, ADDED, sliced=True)


def run_lines(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")
