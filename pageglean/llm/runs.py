"""Sorted Arrow batches cut between groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def changes(columns: Sequence[np.ndarray]) -> np.ndarray:
    """Where a row's values differ from those of the row before; the first row counts."""
    found = np.ones(len(columns[0]), dtype=bool)
    if len(found):
        found[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(found)


def whole_groups(batches: Iterator[pa.RecordBatch], names: Sequence[str], keys: Sequence[str], rows: int) -> Iterator[dict[str, np.ndarray]]:
    """Columns of about ``rows`` rows at a time (more for a larger group), with each run of equal ``keys`` in one piece."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append({name: batch.column(name).to_numpy(zero_copy_only=False) for name in names})
        n += batch.num_rows
        if n < rows:
            continue
        every = {name: np.concatenate([h[name] for h in held]) for name in names}
        # The last group may go on in the next batch.
        last = int(changes([every[k] for k in keys])[-1])
        if last:
            yield {name: v[:last] for name, v in every.items()}
        held, n = [{name: v[last:] for name, v in every.items()}], n - last
    if n:
        yield {name: np.concatenate([h[name] for h in held]) for name in names}
