"""Longest common extensions of a sequence by a difference cover.

Only suffixes that start at places of a difference cover are sorted: first by the words up to one cover period, then by
prefix doubling over the sample, whose places one period on are in the sample again. Two places reach sampled places
within less than a period of steps, so an extension compares a few words and then takes one range minimum over the common
prefixes of neighbouring sampled suffixes, from a sparse table.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set; every difference modulo 31 is that of two of its members.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)


def _shifts() -> np.ndarray:
    """``[a, b]``: the fewest steps after which places of residues ``a`` and ``b`` are both in the cover."""
    inside = np.zeros(PERIOD, dtype=bool)
    inside[list(COVER)] = True
    a, b, step = np.ogrid[:PERIOD, :PERIOD, :PERIOD]
    return np.argmax(inside[(a + step) % PERIOD] & inside[(b + step) % PERIOD], axis=2)


_SHIFT = _shifts()


class Extensions:
    """Common extensions of a sequence of integers from 0.

    The last one must occur nowhere else, nor may any that separates parts which extensions must not leave.
    """

    def __init__(self, sequence: np.ndarray) -> None:
        self.sequence = np.asarray(sequence, dtype=np.int64)
        n = len(self.sequence)
        sampled = np.zeros(n + PERIOD, dtype=bool)
        sampled[:n] = np.isin(np.arange(n) % PERIOD, COVER)
        self.places = np.flatnonzero(sampled)
        self.number = np.cumsum(sampled) - 1  # of the sampled place
        snapshots = self._sort()
        self._sparse = self._table(snapshots)

    def _refine(self, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Ranks of suffixes that were tied, by ``key``, which begins with their old rank; those still tied."""
        order = np.argsort(key, kind="stable")
        tied, key, old = tied[order], key[order], self.rank[tied[order]]
        at = np.arange(len(tied))
        new_group = np.ones(len(tied), dtype=bool)
        new_group[1:] = key[1:] != key[:-1]
        old_group = np.ones(len(tied), dtype=bool)
        old_group[1:] = old[1:] != old[:-1]
        begin = np.maximum.accumulate(np.where(new_group, at, 0))
        self.rank[tied] = old + begin - np.maximum.accumulate(np.where(old_group, at, 0))
        alone = new_group & np.append(new_group[1:], True)
        return tied[~alone]

    def _sort(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes; returned: ranks by the first 31, 62, 124, .. words."""
        m = len(self.places)
        self.rank = np.zeros(m, dtype=np.int64)  # place of the first suffix of its group
        words = np.append(self.sequence + 1, np.zeros(2 * PERIOD, dtype=np.int64))
        width = int(words.max(initial=1)).bit_length()
        at_once = max(1, (62 - m.bit_length()) // width)
        tied, depth = np.arange(m), 0
        while len(tied) and depth < PERIOD:
            key = self.rank[tied]
            for k in range(depth, min(PERIOD, depth + at_once)):
                key = (key << width) | words[self.places[tied] + k]
            tied, depth = self._refine(tied, key), depth + at_once
        snapshots, length = [self.rank.copy()], PERIOD
        while len(tied):
            tied = self._refine(tied, self.rank[tied] * (m + 1) + self._rank_after(self.rank, tied, length))
            snapshots.append(self.rank.copy())
            length *= 2
        return snapshots

    def _rank_after(self, rank: np.ndarray, sampled: np.ndarray, length: int) -> np.ndarray:
        """1 + rank of the suffix ``length`` words on (a multiple of the period); 0 past the end."""
        place = self.places[sampled] + length
        inside = place < len(self.sequence)
        return np.where(inside, rank[self.number[np.where(inside, place, 0)]] + 1, 0)

    def _matching(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from places ``a`` and ``b`` on, at most ``most`` (less than a period)."""
        out = np.zeros(len(a), dtype=np.int64)
        going = np.flatnonzero(most > 0)
        for k in range(PERIOD):
            if not len(going):
                break
            x, y = a[going] + k, b[going] + k
            inside = np.maximum(x, y) < len(self.sequence)
            going, x, y = going[inside], x[inside], y[inside]
            going = going[self.sequence[x] == self.sequence[y]]
            out[going] += 1
            going = going[most[going] > k + 1]
        return out

    def _table(self, snapshots: list[np.ndarray]) -> list[np.ndarray]:
        """Sparse table of the words that neighbouring sampled suffixes share."""
        order = np.empty(len(self.places), dtype=np.int64)
        order[self.rank] = np.arange(len(order))
        a, b = order[:-1], order[1:]
        shared = np.zeros(len(a), dtype=np.int64)
        for level in reversed(range(len(snapshots))):
            length, rank = PERIOD << level, snapshots[level]
            x, y = self.places[a] + shared, self.places[b] + shared
            inside = np.maximum(x, y) < len(self.sequence)
            x, y = np.where(inside, x, 0), np.where(inside, y, 0)
            shared += np.where(inside & (rank[self.number[x]] == rank[self.number[y]]), length, 0)
        shared += self._matching(self.places[a] + shared, self.places[b] + shared, np.full(len(a), PERIOD - 1))
        sparse, span = [shared], 1
        while 2 * span <= len(shared):
            sparse.append(np.minimum(sparse[-1][:-span], sparse[-1][span:]))
            span *= 2
        return sparse

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from the different places ``a`` and ``b`` on are equal."""
        shift = _SHIFT[a % PERIOD, b % PERIOD]
        out = self._matching(a, b, shift)
        reached = np.flatnonzero(out == shift)
        if len(reached):
            first = self.rank[self.number[a[reached] + shift[reached]]]
            second = self.rank[self.number[b[reached] + shift[reached]]]
            low, high = np.minimum(first, second), np.maximum(first, second)
            level = np.frexp((high - low).astype(np.float64))[1] - 1  # of the largest power of two not above
            for each in np.unique(level):
                here = level == each
                row = self._sparse[each]
                least = np.minimum(row[low[here]], row[high[here] - (1 << int(each))])
                out[reached[here]] += least
        return out
