"""SentencePiece ids of whole texts and back, by a table of distinct chunks.

A batch of texts is cut into chunks (marked words), which become numbers into the table of its distinct chunks; each
distinct chunk is segmented once, and the ids are joined back by position. All of it is array work: the distinct chunks
are segmented side by side, one merge of each in a round. The table is that of a slice of some megabytes of text: one of the
whole corpus would have to be joined with every occurrence of every word, which moves several times the corpus through the
shuffle. Nothing is shuffled here, and a task holds one slice.

Ids equal those of the library without begin and end ids. Null or empty text: no ids, decoded as the empty text.
Columns of the added names are replaced; others may have any name.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from orderlake.llm.frames import appended
from orderlake.llm.pieces import LONGEST_CACHED, MARK, ChunkTable, PieceModel, chunks, marked, merge_pairs, piece_model


def segment(chunk: str, model: PieceModel) -> tuple[int, ...]:
    """Ids of one marked chunk; characters without a piece give the ids of their bytes."""
    ends, _ = merge_pairs(chunk, model.priority)
    out: list[int] = []
    at = 0
    while at < len(chunk):
        piece = chunk[at : ends[at]]
        known = model.id_of.get(piece)
        out += [known] if known is not None else [model.byte_ids[b] for b in piece.encode()]
        at = ends[at]
    return tuple(out)


class PairTable:
    """Which two neighbouring symbols make a piece, how good a merge that is, and its symbol.

    Symbols are the pieces by id and, from there on, the other characters by their code points.
    """

    def __init__(self, model: PieceModel) -> None:
        self.n_pieces = len(model.pieces)
        self.base = self.n_pieces + 0x110000
        symbols = {c: self.n_pieces + ord(c) for p in model.id_of for c in p} | model.id_of
        chars = sorted((ord(p), i) for p, i in model.id_of.items() if len(p) == 1)
        self.chars, self.symbol_of_char = (np.array(x, dtype=np.int64) for x in zip(*chars, strict=True))
        rank = {x: r for r, x in enumerate(sorted(set(model.priority.values())))}
        pairs = sorted(
            (symbols[p[:k]] * self.base + symbols[p[k:]], rank[model.priority[p]], i)
            for p, i in model.id_of.items()
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        )
        self.keys, self.ranks, self.merged = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))

    def of_chars(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        return np.where(self.chars[at] == points, self.symbol_of_char[at], self.n_pieces + points)

    def best(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of each pair; no rank is as high as ``NO_PAIR``."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NO_PAIR), self.merged[at]


NO_PAIR = 1 << 30


@lru_cache(maxsize=4)
def _pair_table(path: str) -> PairTable:
    return PairTable(piece_model(path))


def merge_all(symbols: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Symbols left of many chunks, and how many each has: in each round every chunk merges its best pair, the leftmost
    of equals, until none has a pair."""
    chunk = np.repeat(np.arange(len(lengths)), lengths)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rank, merged = pairs.best(symbols[:-1], symbols[1:]) if len(symbols) else (symbols, symbols)
    rank = np.append(rank, NO_PAIR)[: len(symbols)]
    merged = np.append(merged, 0)[: len(symbols)]
    rank[np.flatnonzero(chunk[1:] != chunk[:-1])] = NO_PAIR
    while len(symbols):
        starts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        best = np.minimum.reduceat((rank << 32) + np.arange(len(rank)), starts)
        going = best < (NO_PAIR << 32)
        if not going.all():
            sizes = np.diff(np.append(starts, len(symbols)))
            over = np.repeat(~going, sizes)
            done.append((chunk[over], symbols[over]))
            moved = np.cumsum(over) - over
            at = best[going] & 0xFFFFFFFF
            at = at - moved[at]
            kept = ~over
            symbols, chunk, rank, merged = symbols[kept], chunk[kept], rank[kept], merged[kept]
        else:
            at = best & 0xFFFFFFFF
        if not len(at):
            continue
        symbols[at] = merged[at]
        left = np.ones(len(symbols), dtype=bool)
        left[at + 1] = False
        number = np.cumsum(left) - 1
        symbols, chunk, rank, merged = symbols[left], chunk[left], rank[left], merged[left]
        at = number[at]
        # Only the pairs on both sides of a merged symbol are new.
        for first in (at, at[at > 0] - 1):
            inside = first[first + 1 < len(symbols)]
            rank[first] = NO_PAIR
            inside = inside[chunk[inside] == chunk[inside + 1]]
            rank[inside], merged[inside] = pairs.best(symbols[inside], symbols[inside + 1])
    if not done:
        return symbols, np.zeros(len(lengths), dtype=np.int64)
    chunk, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(chunk, kind="stable")
    return symbols[order], np.bincount(chunk, minlength=len(lengths))


def segment_all(distinct: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct chunks, one after another, and how many each has."""
    model, pairs = piece_model(path), _pair_table(path)
    names = list(map(marked, distinct))
    lengths = np.fromiter(map(len, names), dtype=np.int64, count=len(names))
    long = lengths > LONGEST_CACHED  # rounds would be as many as its merges: such a chunk has a heap of its own
    points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    whole = np.repeat(~long, lengths)
    symbols, sizes = merge_all(pairs.of_chars(points[whole]), np.where(long, 0, lengths), pairs)
    symbols, sizes = _as_bytes(symbols, sizes, model)
    if not long.any():
        return symbols, sizes
    ends, out, at = np.cumsum(sizes), [], 0
    for i in np.flatnonzero(long).tolist():
        out += [symbols[at : ends[i]], np.array(segment(names[i], model), dtype=np.int64)]
        at = ends[i]
    sizes[long] = [len(x) for x in out[1::2]]
    return np.concatenate([*out, symbols[at:]]), sizes


def _as_bytes(symbols: np.ndarray, sizes: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of chunks with characters that are no pieces replaced by the ids of their bytes."""
    odd = symbols >= len(model.pieces)
    if not odd.any():
        return symbols, sizes
    chars, which = np.unique(symbols[odd] - len(model.pieces), return_inverse=True)
    ids = [[model.byte_ids[b] for b in chr(c).encode()] for c in chars.tolist()]
    width = np.ones(len(symbols), dtype=np.int64)
    width[odd] = np.array([len(x) for x in ids])[which]
    out = np.repeat(symbols, width)
    out[np.repeat(odd, width)] = np.concatenate([ids[i] for i in which.tolist()])
    upto = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(sizes)])]
    return out, np.diff(upto)


@lru_cache(maxsize=4)
def _segments(path: str) -> ChunkTable:
    model = piece_model(path)
    return ChunkTable(lambda chunk: segment(chunk, model))


@lru_cache(maxsize=4)
def _surfaces(path: str) -> list[str]:
    """Text of each id; bytes are resolved later, control ids have none."""
    model = piece_model(path)
    return ["" if i in model.control else p.replace(MARK, " ") for i, p in enumerate(model.pieces)]


def encode_text(text: str | None, path: str) -> list[int]:
    return list(chain.from_iterable(map(_segments(path).__getitem__, chunks(text or ""))))


def _chunk_column(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts one after another, and how many each text has."""
    plain = pc.replace_substring(texts.fill_null(""), MARK, " ")
    parts = pc.split_pattern(plain, " ")
    odd = pc.or_(pc.match_substring(plain, "  "), pc.or_(pc.starts_with(plain, " "), pc.ends_with(plain, " ")))
    odd = pc.or_(odd, pc.equal(plain, ""))
    counts = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = parts.flatten()
    rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if not len(rows):
        return flat, counts
    # Runs of markers belong to the word behind them: such texts are cut one by one.
    pieces, at, first = [], 0, np.concatenate([[0], np.cumsum(counts)])
    for i in rows.tolist():
        own = chunks(plain[i].as_py())
        pieces += [flat.slice(first[at], first[i] - first[at]), pa.array(own, flat.type)]
        counts[i], at = len(own), i + 1
    return pa.concat_arrays([*pieces, flat.slice(first[at])]), counts


def encode_column(texts: pa.Array, path: str) -> pa.ListArray:
    """The ids of each text."""
    cut, counts = _chunk_column(texts)
    table = cut.dictionary_encode()
    ids, sizes = segment_all(table.dictionary.to_pylist(), path)
    chunk = table.indices.to_numpy(zero_copy_only=False)
    # Ids by position: each chunk's place in the table's ids, counted on through its own.
    size = sizes[chunk]
    upto = np.cumsum(size)
    begin = (np.cumsum(sizes) - sizes)[chunk] - (upto - size)
    flat = ids[np.repeat(begin, size) + np.arange(int(size.sum()))]
    bounds = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(counts)])]
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32)))


def _bytes_text(data: bytes) -> str:
    """UTF-8 text of bytes; each byte that is part of no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


def decode_ids(ids: list[int], path: str) -> str:
    """Text of ids: markers become spaces, the one in front goes, runs of byte ids become characters."""
    model, surfaces = piece_model(path), _surfaces(path)
    if model.byte_of.keys().isdisjoint(ids):
        text = "".join([surfaces[i] for i in ids])
    else:
        parts: list[str] = []
        run = bytearray()
        for i in ids:
            if i in model.byte_of:
                run.append(model.byte_of[i])
                continue
            if run:
                parts.append(_bytes_text(bytes(run)))
                run.clear()
            parts.append(surfaces[i])
        if run:
            parts.append(_bytes_text(bytes(run)))
        text = "".join(parts)
    return text[1:] if ids and model.pieces[ids[0]].startswith(MARK) else text


@lru_cache(maxsize=4)
def _surface_column(path: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Text of each id; whether it is that of a byte, and whether it begins with a marker."""
    model = piece_model(path)
    is_byte = np.zeros(len(model.pieces), dtype=bool)
    is_byte[list(model.byte_of)] = True
    return pa.array(_surfaces(path)), is_byte, np.array([p.startswith(MARK) for p in model.pieces])


def decode_column(ids: pa.ListArray, path: str) -> pa.Array:
    """The text of each list of ids."""
    surfaces, is_byte, is_marked = _surface_column(path)
    ids = ids.fill_null([])
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    texts = pc.binary_join(pa.ListArray.from_arrays(offsets, surfaces.take(pa.array(flat))), "")
    first = np.zeros(len(ids), dtype=bool)
    some = ends > begins
    first[some] = is_marked[flat[begins[some]]]
    texts = pc.if_else(pa.array(first), pc.utf8_slice_codeunits(texts, 1), texts)
    bytes_before = np.concatenate([[0], np.cumsum(is_byte[flat])])
    rows = np.flatnonzero(bytes_before[ends] > bytes_before[begins])
    if not len(rows):
        return texts
    # Bytes become characters together: such texts are put together one by one.
    out = texts.to_pylist()
    for i in rows.tolist():
        out[i] = decode_ids(flat[begins[i] : ends[i]].tolist(), path)
    return pa.array(out, pa.string())


def encode(df: DataFrame, model_path: str, text_col: str = "text", into: str = "piece_ids") -> DataFrame:
    """``df`` with the ids of each text as an array of integers."""
    return appended(df, [text_col], lambda t: [encode_column(t, model_path)], f"`{into}` array<int>", sliced=True)


def decode(df: DataFrame, model_path: str, ids_col: str = "piece_ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of each array of ids; null ids give the empty text."""
    return appended(df, [ids_col], lambda ids: [decode_column(ids, model_path)], f"`{into}` string")
