"""Splitting oversized texts at natural boundaries with a sparse-table range maximum.

Every position that directly follows a boundary has a strength. A sparse table over (strength, position) answers "the
strongest cut in this window, the rightmost among equals" in constant time, so a text costs O(b log w) to index and O(1)
per piece, however long it is. One narrow stage: no shuffle, and the text itself is not carried into the output unless asked for.

Defined results: NULL texts and texts within the limit give no rows; where a window has no boundary the cut is at the limit, so text
without any spaces is split too; offsets are code points; repeated rows give repeated output; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SplitRule:
    limit: int = 2500
    overlap: int = 200
    shortest: int = 1250  # a piece other than the last is longer than this

    def __post_init__(self) -> None:
        if not 0 <= self.overlap <= self.shortest < self.limit:
            raise ValueError("0 <= overlap <= shortest < limit must hold, else the pieces would not advance")


SENTENCE, WORD, LINE, PARAGRAPH = 2, 1, 3, 4


def boundary_strengths(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, strengths) of the cuts of a text given as code points; a cut at c separates c - 1 from c."""
    n = len(codes)
    strength = np.zeros(n + 1, np.int8)
    space = np.flatnonzero(codes == 32) + 1
    strength[space] = WORD
    after = space[space >= 2]
    before = codes[after - 2]
    strength[after[(before == 46) | (before == 33) | (before == 63)]] = SENTENCE
    feed = np.flatnonzero(codes == 10) + 1
    strength[feed] = LINE
    pair = feed[feed >= 2]
    strength[pair[codes[pair - 2] == 10]] = PARAGRAPH
    at = np.flatnonzero(strength)
    return at, strength[at]


class RangeMaximum:
    """Sparse table over keys; ``best(i, j)`` is the largest key in ``[i, j)``. Levels are built as far as asked for."""

    def __init__(self, keys: np.ndarray):
        self._levels = [keys]

    def best(self, i: int, j: int) -> int:
        k = (j - i).bit_length() - 1
        while len(self._levels) <= k:
            half = 1 << (len(self._levels) - 1)
            low = self._levels[-1]
            self._levels.append(np.maximum(low[:-half], low[half:]))
        level = self._levels[k]
        return max(int(level[i]), int(level[j - (1 << k)]))


def split_points(text: str, rule: SplitRule) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text, empty if it is within the limit."""
    n = len(text)
    if n <= rule.limit:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at, strength = boundary_strengths(codes)
    table = RangeMaximum(strength.astype(np.int64) << 48 | at)
    pieces, start = [], 0
    while n - start > rule.limit:
        i, j = np.searchsorted(at, (start + rule.shortest, start + rule.limit), side="right").tolist()
        end = table.best(i, j) & ((1 << 48) - 1) if i < j else start + rule.limit
        pieces.append((start, end))
        start = end - rule.overlap
    pieces.append((start, n))
    return pieces


def split_texts(texts: DataFrame, key: str = "id", text: str = "content", rule: SplitRule = SplitRule(), with_text: bool = False) -> DataFrame:
    """(page_id, piece_no, total_pieces, start_char, end_char[, piece]) of every text longer than the limit."""
    source = texts.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).where(F.length("t") > rule.limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pieces = split_points(t, rule)
                for i, (a, b) in enumerate(pieces):
                    for column, value in zip(out, (k, i, len(pieces), a, b, t[a:b] if with_text else None)):
                        column.append(value)
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            arrays = [pa.array(c, kind) for c, kind in zip(out, kinds)][: 6 if with_text else 5]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "piece_no", "total_pieces", "start_char", "end_char", "piece"][: len(arrays)])

    schema = "page_id string, piece_no int, total_pieces int, start_char int, end_char int" + ", piece string" * with_text
    return source.mapInArrow(run, schema)
