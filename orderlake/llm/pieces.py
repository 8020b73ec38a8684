"""Pieces of a SentencePiece BPE model, and the marked words ("chunks") that its pieces never cross.

Spaces become markers and a text that is not empty gets one in front. No piece has a marker after another character
(checked when a model is read), so no merge crosses from a word into the marker of the next one: a text may be cut in
front of every run of markers and each part segmented by itself.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

MARK = "▁"
LONGEST_CACHED = 64  # longer chunks are rare and are not kept


class PieceModel:
    """Vocabulary of a model file: priority of each mergeable piece, its id, and the ids of single bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.control = {i for i in ids if model.is_control(i) or model.is_unknown(i)}
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in ids if model.is_byte(i)}
        self.byte_ids = [i for i, _ in sorted(self.byte_of.items(), key=lambda x: x[1])]
        self.id_of = {self.pieces[i]: i for i in ids if i not in self.byte_of and i not in self.control}
        self.priority = {p: -model.get_score(i) for p, i in self.id_of.items()}
        if len(self.byte_ids) != 256 or any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("pieces cross markers or bytes have no pieces: this model needs another method")

    def unknown_cost(self, char: str) -> int:
        """Ids that a character outside the vocabulary takes besides the first."""
        return 0 if char in self.id_of else len(char.encode()) - 1


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    """The model of a file, read once by each Python worker."""
    return PieceModel(path)


def chunks(text: str) -> list[str]:
    """Chunks of a text in order; of the usual chunk, a word with one marker, the marker is left out."""
    if not text:
        return []
    parts = text.replace(MARK, " ").split(" ")
    if "" not in parts:
        return parts
    out, marks = [], 0
    for part in parts:
        marks += 1
        if part:
            out.append(part if marks == 1 else MARK * marks + part)
            marks = 0
    if marks:
        out.append(MARK * marks)
    return out


def marked(chunk: str) -> str:
    return chunk if chunk.startswith(MARK) else MARK + chunk


def merge_pairs(chunk: str, priority: dict[str, float]) -> tuple[list[int], int]:
    """Byte-pair merges of a chunk: where the symbol that starts at each place ends, and how many merges there were.

    A heap gives the pair of best priority, the leftmost of equals; ``ends`` and ``before`` link the symbols that
    are left. An entry whose symbols have changed since it was pushed is passed over. O(n log n).
    """
    n = len(chunk)
    ends = list(range(1, n + 1))
    before = list(range(-1, n))
    heap = [(p, i, i + 2) for i in range(n - 1) if (p := priority.get(chunk[i : i + 2])) is not None]
    heapify(heap)
    merges = 0
    while heap:
        _, left, end = heappop(heap)
        middle = ends[left]
        if middle <= left or middle >= n or ends[middle] != end:
            continue
        ends[left], ends[middle] = end, -1
        merges += 1
        if end < n:
            before[end] = left
            after = ends[end]
            if (p := priority.get(chunk[left:after])) is not None:
                heappush(heap, (p, left, after))
        up = before[left]
        if up >= 0 and (p := priority.get(chunk[up:end])) is not None:
            heappush(heap, (p, up, end))
    return ends, merges


class ChunkTable(dict):
    """What ``make`` gives for each distinct chunk, made once; emptied when it holds ``limit`` chunks."""

    def __init__(self, make, limit: int = 300_000) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, chunk: str):
        value = self.make(marked(chunk))
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = value
        return value
