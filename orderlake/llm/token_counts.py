"""Token counts of whole texts by heap-and-linked-list byte-pair merging.

A text is cut into chunks that merges cannot cross; a heap gives the best adjacent pair of a chunk, linked symbols
keep what is left, and the count is the number of initial symbols less the number of merges. No ids are made. A
character that no merge took up and that has no piece counts as its bytes. Each task keeps the counts of a bounded
number of distinct chunks. Nothing is shuffled.

Null or empty text: no bytes, no tokens. Existing columns of the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import extended, with_columns, without
from orderlake.llm.pieces import ChunkTable, PieceModel, chunks, merge_pairs, piece_model
from orderlake.llm.text import slices


def count_chunk(chunk: str, model: PieceModel) -> int:
    ends, merges = merge_pairs(chunk, model.priority)
    extra = 0
    if any(c not in model.id_of for c in chunk):
        extra = sum(model.unknown_cost(c) for i, c in enumerate(chunk) if ends[i] == i + 1)
    return len(chunk) - merges + extra


@lru_cache(maxsize=4)
def _counts(path: str) -> ChunkTable:
    model = piece_model(path)
    return ChunkTable(lambda chunk: count_chunk(chunk, model))


def count_text(text: str | None, path: str) -> int:
    return sum(map(_counts(path).__getitem__, chunks(text or "")))


def count_tokens(
    df: DataFrame, model_path: str, text_col: str = "text", limit: int = 4096, prefix: str = ""
) -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    n_bytes, n_tokens, over = (f"{prefix}{c}" for c in ("n_bytes", "n_tokens", "over_limit"))
    base = without(df, [n_bytes, n_tokens, over])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            counts = [count_text(t, model_path) for t in texts]
            yield with_columns(batch, (), **{n_tokens: pa.array(counts, pa.int64())})

    counted = base.mapInArrow(run, extended(base, f"`{n_tokens}` bigint"))
    length = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint")
    return counted.select(*base.columns, length.alias(n_bytes), n_tokens, (F.col(n_tokens) > limit).alias(over))
