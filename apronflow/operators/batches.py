"""Arrow batches of a sorted partition, cut into whole groups.

A grouped Python call costs about a millisecond, so operators with many small groups stream their
sorted partitions instead and work on thousands of groups at once with numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa


def changes(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """True at each row that begins a group of equal consecutive keys."""
    new = np.zeros(table.num_rows, dtype=bool)
    if table.num_rows:
        new[0] = True
    for name in names:
        col = table.column(name).combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks == 1 else pa.concat_arrays(col.chunks)
        if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
            col = col.dictionary_encode().indices
        values = col.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return new


def whole_groups(
    batches: Iterable[pa.RecordBatch], names: Sequence[str], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], rows: int = 65_536
) -> Iterator[pa.RecordBatch]:
    """Calls work(table, starts) on tables of whole groups; starts are the groups' first rows.

    The partition must be sorted by names. Memory is bounded by rows plus the largest group, so the
    caller's keys must bound their groups (for example one source and one day).
    """
    held: list[pa.RecordBatch] = []
    count, limit = 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < limit:
            continue
        whole = pa.Table.from_batches(held)
        starts = np.flatnonzero(changes(whole, names))
        cut = int(starts[-1])
        if cut:
            yield from work(whole.slice(0, cut), starts[:-1])
            whole = whole.slice(cut)
        held, count = whole.to_batches(), whole.num_rows
        limit = count + rows
    if count:
        whole = pa.Table.from_batches(held)
        yield from work(whole, np.flatnonzero(changes(whole, names)))


def doubles(table: pa.Table, name: str) -> np.ndarray:
    """A float column as numpy, null as NaN."""
    return np.asarray(table.column(name).to_numpy(), dtype=np.float64)


def integers(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table.column(name).to_numpy(), dtype=np.int64)


def flags(table: pa.Table, name: str) -> np.ndarray:
    """A boolean column; null counts as false."""
    return np.asarray(table.column(name).combine_chunks().fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
