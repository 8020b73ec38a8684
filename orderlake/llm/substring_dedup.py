"""Repeated word sequences: suffix automata of reference shards, documents streamed through them.

A word is removed if a window of ``window`` consecutive words over it also starts in a document with a smaller id.

One automaton of the whole corpus cannot be broadcast at scale, so the corpus is cut into shards by content. The
anchor of a window is the smallest hash of its five-word grams: equal windows have equal anchors, so all windows of
one anchor meet in one shard wherever they stand, and a shard knows every document that matters to it.

1. Anchors of every document; those found in one document only are put aside (most of them).
2. For the others each document has stretches: the words whose windows have that anchor. Equal stretches of a task
   are sent once, with the smallest and largest document that has them.
3. A shard is a range of anchors. Its suffix automaton is built over its stretches, every state with the smallest
   document id it occurs in; the stretches are streamed through it for their matching statistics, cut off at
   the window length, which gives the first document of each window.
4. Documents look up their stretches in a join that adaptive execution can split, and lose the words of windows with
   an earlier document.

An anchor found in more than ``hot`` documents would make too large a shard: its windows are stretches of their own
there, and meet by the hash of the whole window. Hashes choose where texts meet and name the stretches in the join (128
bits); words are compared by the automaton.

Null text: no words. Null id: neither removes nor loses words. Rows of equal id do not remove each other's words;
repeated rows each come back. Empty tables give empty tables. Existing columns of the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.frames import table, without
from orderlake.llm.text import Words, grams, mix, slices, sliding_min, words_of

GRAM = 5  # words of an anchor
HOT = 5000  # occurrences of an anchor beyond which its windows go to shards of their own
SHARD_WORDS = 20_000  # words of one automaton, more only if one anchor has more
COMBINE_BYTES = 32 << 20  # stretches a task holds back to send equal ones once
ADDED = "n_words bigint, n_removed bigint, kept_text string"


class SuffixAutomaton:
    """Suffix automaton of several word sequences; each state holds the smallest document it occurs in."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.document: list[int | None] = [None]

    def _state(self, transitions: dict, link: int, length: int, document: int | None) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        self.document.append(document)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word) -> int:
        """A copy of ``q`` for the strings that reach it from ``p`` and its suffixes."""
        nxt, link = self.next, self.link
        copy = self._state(nxt[q].copy(), link[q], self.length[p] + 1, None)
        link[q] = copy
        while p != -1 and nxt[p].get(word) == q:
            nxt[p][word] = copy
            p = link[p]
        return copy

    def add(self, words, document: int) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            q = nxt[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, q, word)
                seen = self.document[last]
                if seen is None or document < seen:
                    self.document[last] = document
                continue
            p, last = last, self._state({}, 0, length[last] + 1, document)
            while p != -1 and word not in nxt[p]:
                nxt[p][word] = last
                p = link[p]
            if p != -1:
                q = nxt[p][word]
                link[last] = q if length[q] == length[p] + 1 else self._split(p, q, word)

    def finish(self) -> None:
        """Hand the smallest document down to all suffixes; call once after the last ``add``."""
        link, document = self.link, self.document
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            up, seen = link[state], document[state]
            if up > 0 and (document[up] is None or seen < document[up]):
                document[up] = seen

    def first_documents(self, words, window: int) -> list[int | None]:
        """For each window of ``words``, the smallest document that holds it."""
        nxt, link, length, document = self.next, self.link, self.length, self.document
        state = matched = 0
        out = []
        for i, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            state = nxt[state].get(word, 0)
            matched = matched + 1 if state else 0
            if matched >= window:
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
            if i >= window - 1:
                out.append(document[state] if matched == window else None)
        return out


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of each window that lies in one text, the window's first word, and the text."""
    smallest = sliding_min(grams(words.hashes, GRAM), window - GRAM + 1)
    text = words.text_of_word()
    n = len(smallest)
    at = np.flatnonzero(text[:n] == text[window - 1 :]) if n else np.zeros(0, dtype=np.int64)
    return smallest[at], at, text[at]


def _emit_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            key, _, text = _anchors(words_of(batch.column(1)), window)
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[new].view(np.int64)), pa.array(ids[text[new]])], ["key", "doc"]
            )

    return run


def _among(key: np.ndarray, text: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Whether each key is in the list of its text."""
    lists = keys.fill_null([])
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    salt = mix(np.arange(len(lists), dtype=np.uint64))
    return np.isin(key ^ salt[text], flat ^ salt[owner])


def _stretches(words: Words, window: int, cold: pa.Array, hot: pa.Array) -> tuple[np.ndarray, ...]:
    """Key, text, first window and last window of each stretch."""
    key, at, text = _anchors(words, window)
    found = _among(key, text, cold)
    k, i, t = key[found], at[found], text[found]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1]) | (i[1:] != i[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(k)) - 1
    single = _among(key, text, hot)
    j = at[single]
    whole = grams(words.hashes, window, 2)[j] if len(j) else np.zeros(0, dtype=np.uint64)
    return (
        np.concatenate([k[begin], whole]),
        np.concatenate([t[begin], text[single]]),
        np.concatenate([i[begin], j]),
        np.concatenate([i[end] if len(end) else end, j]),
    )


def _each_stretch(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple]:
    """(doc, row) columns, key, text number, first word in the text, and bytes, of the stretches of each slice."""
    for batch in slices(batches, "text"):
        doc, row, column, cold, hot = batch.columns[:5]
        words = words_of(column)
        key, text, first, last = _stretches(words, window, cold, hot)
        data = words.data.tobytes()
        low, high = words.starts[first].tolist(), words.ends[last + window - 1].tolist()
        parts = [data[a:b] for a, b in zip(low, high, strict=True)]
        yield doc, row, key.view(np.int64), text, first - words.first[text], parts


def _emit_references(window: int):
    """Each stretch once a task, or once in ``COMBINE_BYTES`` of them, with the range of documents that have it."""

    def flush(seen: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in seen], pa.int64()),
                pa.array([x for _, x in seen], pa.binary()),
                pa.array([v[0] for v in seen.values()], pa.int64()),
                pa.array([v[1] for v in seen.values()], pa.int64()),
            ],
            ["key", "stretch", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple] = {}
        size = 0
        for doc, _, key, text, _, parts in _each_stretch(batches, window):
            ids = doc.take(pa.array(text)).to_pylist()
            for found in zip(ids, key.tolist(), parts, strict=True):
                i, name = found[0], found[1:]
                known = seen.get(name)
                if known is None:
                    seen[name] = (i, i)
                    size += len(name[1]) + 200
                elif not known[0] <= i <= known[1]:
                    seen[name] = (min(i, known[0]), max(i, known[1]))
            if size > COMBINE_BYTES:
                yield flush(seen)
                seen, size = {}, 0
        if seen:
            yield flush(seen)

    return run


def _emit_places(window: int):
    """Where each stretch stands: key, hash of its bytes, document, row and first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, row, key, text, at, parts in _each_stretch(batches, window):
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array([_name(x) for x in parts], pa.int64()), doc.take(owner), row.take(owner),
                 pa.array(at)],
                ["key", "name", "doc", "row", "at"],
            )

    return run


def _name(stretch: bytes) -> int:
    return xxhash.xxh64_intdigest(stretch) - (1 << 63)


def _match_shard(rows: dict[tuple[int, bytes], tuple[int, int]], window: int) -> Iterator[tuple]:
    """(key, name, first document of each window) of stretches that some document loses words of."""
    tokens = {name: name[1].split() for name in rows}
    automaton = SuffixAutomaton()
    for name, (low, _) in rows.items():
        automaton.add(tokens[name], low)
    automaton.finish()
    for name, (_, high) in rows.items():
        least = automaton.first_documents(tokens[name], window)
        if min(least) < high:
            yield name[0], _name(name[1]), least


def _match(window: int):
    """Shards of consecutive keys, each matched against its own automaton."""

    def shard(rows: dict) -> pa.RecordBatch:
        found = list(_match_shard(rows, window))
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
             pa.array([f[2] for f in found], pa.list_(pa.int64()))],
            ["key", "name", "least"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple[int, bytes], tuple[int, int]] = {}
        size, last = 0, None
        for batch in batches:
            for key, stretch, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SHARD_WORDS and key != last:
                    yield shard(rows)
                    rows, size = {}, 0
                last = key
                known = rows.get((key, stretch))
                rows[key, stretch] = (low, high) if known is None else (min(low, known[0]), max(high, known[1]))
                size += 0 if known else stretch.count(b" ") + 1
        if rows:
            yield shard(rows)

    return run


def _covered(places: list[dict], row: int, doc: int, window: int) -> Iterator[tuple[int, int]]:
    """Spans of words, in order, under the windows that an earlier document has."""
    hits = sorted(
        p["at"] + i for p in places if p["row"] == row for i, first in enumerate(p["least"]) if first < doc
    )
    begin = end = None
    for at in hits:
        if begin is None or at > end:
            if begin is not None:
                yield begin, end
            begin = at
        end = at + window
    if begin is not None:
        yield begin, end


def _cut(names: list[str], window: int):
    """Rows of (id, row, text, other columns, places of stretches) with the repeated words taken out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            total, removed, kept = [], [], []
            given = (columns[c].to_pylist() for c in ("_doc", "_text", "_row", "_places"))
            for doc, text, row, places in zip(*given, strict=True):
                words = (text or "").encode().split()
                gone = after = 0
                rest: list[bytes] = []
                for a, b in _covered(places or [], row, doc, window):
                    rest += words[after:a]
                    gone += b - a
                    after = b
                rest += words[after:]
                total.append(len(words))
                removed.append(gone)
                kept.append(b" ".join(rest).decode())
            yield pa.RecordBatch.from_arrays(
                [columns[c] for c in names]
                + [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                [*names, "n_words", "n_removed", "kept_text"],
            )

    return run


def _repeats(known: DataFrame, window: int, hot: int) -> DataFrame:
    """Stretches with words that an earlier document has, of (_doc, _row, _text) rows: doc, row, at, least."""
    anchors = known.select("_doc", F.col("_text").alias("text")).mapInArrow(
        _emit_anchors(window), "key bigint, doc bigint"
    )
    shared = (
        anchors.groupBy("key")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"))
        .where("low < high")
        .select("key", (F.col("n") > hot).alias("is_hot"))
    )
    # Both readers below take this list; written once, a tenth of the anchors.
    listed = table(
        anchors.join(shared, "key")
        .groupBy("doc")
        .agg(
            F.collect_list(F.when(~F.col("is_hot"), F.col("key"))).alias("cold_keys"),
            F.collect_list(F.when(F.col("is_hot"), F.col("key"))).alias("hot_keys"),
        ),
        "anchors",
        release=True,
    )
    # Other columns come along unread: so this is the very shuffle that the last join reads, and is written once.
    others = [c for c in known.columns if c.startswith("_other")]
    holding = known.join(listed, F.expr("_doc = doc")).select(
        "doc", "_row", F.col("_text").alias("text"), "cold_keys", "hot_keys", *others
    )
    matched = (
        holding.mapInArrow(_emit_references(window), "key bigint, stretch binary, low bigint, high bigint")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_match(window), "key bigint, name bigint, least array<bigint>")
    )
    places = holding.mapInArrow(_emit_places(window), "key bigint, name bigint, doc bigint, row bigint, at bigint")
    return (
        places.join(matched, ["key", "name"])
        .where("array_min(least) < doc")
        .select("doc", "row", "at", "least")
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, hot: int = HOT
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space)."""
    if window < GRAM:
        raise ValueError(f"a window has at least {GRAM} words")
    base = without(docs, ["n_words", "n_removed", "kept_text"])
    others = [c for c in base.columns if c not in (id_col, text_col)]
    source = base.select(
        F.col(id_col).alias("_doc"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("_row"),
        F.col(text_col).alias("_text"),
        *[F.col(c).alias(f"_other{i}") for i, c in enumerate(others)],
    )
    known = source.where("_doc IS NOT NULL")  # shuffled by id once, read by every join below
    places = _repeats(known, window, hot).groupBy("doc").agg(
        F.collect_list(F.struct("row", "at", "least")).alias("_places")
    )
    joined = known.join(places, F.expr("_doc = doc"), "left").drop("doc")
    rows = joined.unionByName(source.where("_doc IS NULL"), allowMissingColumns=True)
    names = [c for c in rows.columns if c not in ("_row", "_places")]
    schema = T.StructType([f for f in rows.schema.fields if f.name in names] + T.StructType.fromDDL(ADDED).fields)
    back = {"_doc": id_col, "_text": text_col} | {f"_other{i}": c for i, c in enumerate(others)}
    cut = rows.mapInArrow(_cut(names, window), schema).withColumnsRenamed(back)
    return cut.select(*base.columns, "n_words", "n_removed", "kept_text")
