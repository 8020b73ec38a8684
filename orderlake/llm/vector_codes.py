"""Vectors as short codes: parts of integer vectors, each replaced by the nearest entry of a codebook of its position.

Lloyd's rounds with active entries: a part keeps its entry and the exact distance to it. In the next round, if that entry
did not move, the part is compared with the moved entries only; parts whose entry moved rescan the whole codebook. All
numbers are integers, and equal distances go to the lower index, so both ways give the same codes.

A round is two passes over the rows: parts are assigned and written with their distances (a table in the shared folder,
from which lost executors go on), then sums by position, entry and component are added up before the shuffle. The driver
holds codebooks (``entries`` vectors) only, and deletes the table of the round before; the last one is what is returned.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped. The vectors of the smallest
ids begin the codebooks (null ids last, ties by vector), fewer if there are fewer. Their first one's length counts: rows
of other lengths, or with a component of more than 2^14, have null ``code`` and ``error``. Lengths that ``parts`` does not
divide are cut as evenly as possible. Repeated rows and columns of any name are kept; existing columns of the added names
are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import appended, drop_table, table, unused_name, without

SCALE = 4096
LARGEST = 1 << 26  # integer components beyond it would not leave room for exact sums of squares


@dataclass(frozen=True)
class Codebooks:
    """Entries by index, whole vectors; the part at a position uses those columns of them."""

    entries: np.ndarray
    bounds: np.ndarray

    def digest(self) -> str:
        """SHA-256 of the decimal components by part, entry and place within the part, joined by commas."""
        numbers = [self.entries[:, a:b].ravel().tolist() for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]
        return hashlib.sha256(",".join(str(x) for part in numbers for x in part).encode()).hexdigest()


def bounds_of(dimension: int, parts: int) -> np.ndarray:
    return np.arange(parts + 1) * dimension // parts


def to_integers(vectors: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """``floor(4096 x)`` of the vectors that can be coded, and which those are."""
    lengths = np.asarray(vectors.value_lengths().fill_null(-1))
    sound = np.flatnonzero(lengths == dimension)
    values = vectors.take(pa.array(sound)).flatten().cast(pa.float64())
    whole = np.floor(SCALE * values.to_numpy(zero_copy_only=False).reshape(len(sound), dimension))
    small = (np.abs(whole) <= LARGEST).all(axis=1)
    return whole[small].astype(np.int64), sound[small]


def distances(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``part`` to every entry."""
    top = int(max(np.abs(part).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * top * top * max(1, part.shape[1]) < 1 << 53:  # then doubles are exact as well, and multiply in blocks
        x, c = part.astype(np.float64), entries.astype(np.float64)
        out = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        return out.astype(np.int64)
    out = np.zeros((len(part), len(entries)), dtype=np.int64)
    for k in range(part.shape[1]):
        out += (part[:, k, None] - entries[None, :, k]) ** 2
    return out


def reassign(
    part: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and the distance to it, lower index first.

    ``code``, ``distance``: those of the round before, ``moved``: entries that changed since. A code of -1 is none.
    """
    code, distance = code.copy(), distance.copy()
    active = np.flatnonzero(moved)
    again = (code < 0) | moved[code]
    held = np.flatnonzero(~again)
    if len(held) and len(active):
        to_active = distances(part[held], entries[active])
        best = to_active.argmin(axis=1)  # the first of equals
        near, index = to_active[np.arange(len(held)), best], active[best]
        better = (near < distance[held]) | ((near == distance[held]) & (index < code[held]))
        code[held[better]], distance[held[better]] = index[better], near[better]
    if again.any():
        to_all = distances(part[again], entries)
        code[again] = to_all.argmin(axis=1)
        distance[again] = to_all[np.arange(len(to_all)), code[again]]
    return code, distance


def _assign(books: Codebooks, moved: np.ndarray):
    """Arrow columns of codes and distances by position from those of the round before (null: none)."""
    parts, dimension = len(books.bounds) - 1, int(books.bounds[-1])

    def compute(vectors: pa.Array, *before: pa.Array) -> list[pa.Array]:
        whole, rows = to_integers(vectors, dimension)
        codes = np.full((len(rows), parts), -1)
        far = np.zeros((len(rows), parts), dtype=np.int64)
        if before:
            taken = [b.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), parts) for b in before]
            codes, far = taken[0].astype(np.int64), taken[1]
        new, near = np.empty_like(codes), np.empty_like(far)
        for p in range(parts):
            a, b = books.bounds[p : p + 2]
            new[:, p], near[:, p] = reassign(whole[:, a:b], books.entries[:, a:b], moved[p], codes[:, p], far[:, p])
        return [_lists(x, rows, len(vectors), kind) for x, kind in ((new, pa.int32()), (near, pa.int64()))]

    return compute


def _lists(values: np.ndarray, rows: np.ndarray, total: int, kind: pa.DataType) -> pa.Array:
    """A list for each of ``rows`` of ``total``, null for the others."""
    flat = pa.array(values.ravel(), kind)
    lists = pa.ListArray.from_arrays(pa.array((np.arange(len(rows) + 1) * values.shape[1]).astype(np.int32)), flat)
    at = np.full(total, -1)
    at[rows] = np.arange(len(rows))
    return lists.take(pa.array(at, mask=at < 0))


def _add_up(parts: int, entries: int, dimension: int):
    """Counts and sums of an Arrow batch: (position, entry, component, sum), component -1 for the count."""
    bounds = bounds_of(dimension, parts)

    def run(batches):
        totals = np.zeros((entries, dimension), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            whole, rows = to_integers(batch.column(0), dimension)
            codes = batch.column(1).take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), parts)
            for p in range(parts):
                a, b = bounds[p : p + 2]
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                for entry in range(entries):
                    totals[entry, a:b] += whole[codes[:, p] == entry, a:b].sum(axis=0)
        p, entry = np.nonzero(counts)
        out = [(p, entry, np.full(len(p), -1), counts[p, entry])]
        for q in range(parts):
            used = np.flatnonzero(counts[q])
            where = np.arange(bounds[q], bounds[q + 1])
            out.append((np.full(len(used) * len(where), q), np.repeat(used, len(where)), np.tile(where, len(used)),
                        totals[np.ix_(used, where)].ravel()))
        columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["position", "entry", "component", "total"])

    return run


def _updated(books: Codebooks, state: DataFrame, vector: str, codes: str) -> tuple[Codebooks, np.ndarray]:
    """Entries as the componentwise floor of their parts' mean; which moved, by position. Unused entries stay."""
    parts = len(books.bounds) - 1
    sums = (
        state.select(F.col(f"`{vector}`").alias("v"), F.col(f"`{codes}`").alias("c"))
        .mapInArrow(
            _add_up(parts, len(books.entries), int(books.bounds[-1])),
            "position bigint, entry bigint, component bigint, total bigint",
        )
        .groupBy("position", "entry", "component")
        .agg(F.sum("total").alias("total"))
        .collect()  # at most entries x (parts + dimension) rows
    )
    count = {(r.position, r.entry): r.total for r in sums if r.component < 0}
    entries = books.entries.copy()
    for r in sums:
        if r.component >= 0:
            entries[r.entry, r.component] = r.total // count[r.position, r.entry]
    changed = entries != books.entries
    moved = [changed[:, a:b].any(axis=1) for a, b in zip(books.bounds[:-1], books.bounds[1:], strict=True)]
    return Codebooks(entries, books.bounds), np.stack(moved)


def sound_vectors(df: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and has only finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return df.where(F.col(f"`{vector_col}`").isNotNull() & F.forall(F.col(f"`{vector_col}`"), finite))


def compress_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
) -> tuple[DataFrame, Codebooks | None]:
    """Rows with sound vectors, ``codes`` (entry by position) and ``error`` (sum of squared distances); the codebooks.

    Without a sound vector there are no codebooks and no rows.
    """
    base = without(df, ["codes", "error"])
    columns = base.columns
    base = sound_vectors(base, vector_col)
    first = (
        base.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        .orderBy(F.col("i").asc_nulls_last(), "v")
        .limit(entries)
        .collect()
    )
    if not first:
        return base.withColumns({"codes": F.lit(None).cast("array<int>"), "error": F.lit(None).cast("bigint")}), None
    dimension = len(first[0].v)
    whole, _ = to_integers(pa.array([r.v for r in first], pa.list_(pa.float64())), dimension)
    books = Codebooks(whole, bounds_of(dimension, parts))
    moved = np.ones((parts, len(whole)), dtype=bool)
    state, read = base, [vector_col]
    codes, far = (unused_name(name, columns) for name in ("codes", "distances"))
    for _ in range(rounds):
        after = table(appended(state, read, _assign(books, moved), f"`{codes}` array<int>, `{far}` array<bigint>"), "codes")
        if state is not base:
            drop_table(state)
        state, read = after, [vector_col, codes, far]
        books, moved = _updated(books, state, vector_col, codes)
    last = appended(state, read, _assign(books, moved), f"`{codes}` array<int>, `{far}` array<bigint>")
    error = F.aggregate(F.col(f"`{far}`"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    kept = [F.col(f"`{c}`") for c in columns]
    coded = table(last.select(*kept, F.col(f"`{codes}`").alias("codes"), error.alias("error")), "codes")
    if state is not base:
        drop_table(state)
    return coded, books


def as_hex(codes: Column) -> Column:
    """Two lower-case hex digits for each entry index."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``label_error``: the errors of all rows with the same label, nulls together, added up before they meet."""
    sums = coded.groupBy(F.col(f"`{label_col}`").alias("_label")).agg(F.sum("error").alias("label_error"))
    base = without(coded, ["label_error"])
    return base.join(sums, F.col(f"`{label_col}`").eqNullSafe(F.col("_label")), "left").drop("_label")
