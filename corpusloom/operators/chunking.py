"""Adaptive chunks: a text is cut into about equal parts, each cut moved to a boundary near its target.

One narrow Arrow stage from texts to chunk rows, without a shuffle. A text that cannot be chunked gives one row with ``error`` and no chunk instead of failing its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.functions.text import TRIMMED

#: What a cut may follow, best first.
BOUNDARIES = ("# ", "## ", "### ", "\n\n", "\n", ".")


@dataclass(frozen=True)
class ChunkRule:
    target: int = 2500
    reach: int = 250


def cut_near(text: str, target: int, reach: int) -> int:
    """Behind the last of the best boundary that lies whole within ``reach`` of ``target``; the target itself if there is none."""
    low, high = max(0, target - reach), min(len(text), target + reach)
    for mark in BOUNDARIES:
        at = text.rfind(mark, low, high)
        if at >= 0:
            return at + len(mark)
    return target


def chunk_text(text: str | None, rule: ChunkRule = ChunkRule()) -> list[tuple[int, int, str]]:
    """(index, total, content). Blank text gives none; a blank last chunk is left out but still counted in the total."""
    if not text or not text.strip(TRIMMED):
        return []
    total = max(1, (2 * len(text) + rule.target) // (2 * rule.target))  # rounded half up
    out, start = [], 0
    for index in range(total - 1):
        end = cut_near(text, start + (len(text) - start) // (total - index), rule.reach)
        out.append((index, total, text[start:end].strip(TRIMMED)))
        start = end
    last = text[start:].strip(TRIMMED)
    return [*out, (total - 1, total, last)] if last else out


def chunk_rows(df: DataFrame, keys: list[str], text: str, rule: ChunkRule = ChunkRule()) -> DataFrame:
    """One row a chunk: the key columns, ``chunk_index``, ``total_chunks``, ``content`` and ``error``, which is NULL but in the row of a text that failed."""
    source = df.select(*keys, df[text].alias("_text"))
    width = len(keys)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:width]), "chunk_index int", "total_chunks int", "content string", "error string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, index, total, content, error = [], [], [], [], []
            for row, value in enumerate(batch.column(width).to_pylist()):
                try:
                    found = [(*piece, None) for piece in chunk_text(value, rule)]
                except Exception as e:  # noqa: BLE001
                    found = [(None, None, None, f"{type(e).__name__}: {e}")]
                for i, n, c, problem in found:
                    owner.append(row)
                    index.append(i)
                    total.append(n)
                    content.append(c)
                    error.append(problem)
            taken = pa.array(owner, pa.int64())
            columns = [batch.column(k).take(taken) for k in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(index, pa.int32()), pa.array(total, pa.int32()), pa.array(content, pa.string()), pa.array(error, pa.string())], names=[*keys, "chunk_index", "total_chunks", "content", "error"])

    return source.mapInArrow(run, schema)
