"""Groups of rows that come sorted by some integer columns, one after another in a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Each group as a table; only the group that is going on is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        new = np.zeros(len(batch), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
        if held and len(batch):
            last = held[-1]
            new[0] = any(last.column(c)[-1].as_py() != x[0] for c, x in zip(names, columns, strict=True))
        first = 0
        for cut in np.flatnonzero(new).tolist():
            if cut > first:
                held.append(batch.slice(first, cut - first))
            yield pa.Table.from_batches(held)
            held, first = [], cut
        if first < len(batch):
            held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held)
