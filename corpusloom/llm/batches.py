"""Whole groups of rows from a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, rows: int, run: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Call ``run`` on tables of about ``rows`` rows that hold whole groups of equal values in the first ``keys`` columns (integers).

    The stream must be sorted by these columns; a table exceeds ``rows`` only by its last group.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(table.num_rows - 1, bool)
        for k in range(keys):
            column = table.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        at = np.flatnonzero(change)
        if len(at):
            cut = int(at[-1]) + 1
            yield from run(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
            held, size = rest.to_batches(), rest.num_rows
    if held:
        yield from run(pa.Table.from_batches(held).combine_chunks())
