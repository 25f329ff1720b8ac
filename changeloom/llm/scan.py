"""Running sums along sorted rows of groups, of which one may span many tasks.

Rows lie in range partitions. Each task sums from the start of a group within its part; what
groups that began in earlier parts bring with them is one row a part, added up on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """Powers modulo 2**64, element by element."""
    out, square = np.ones(len(exponents), _U), _U(base)
    left = exponents.astype(_U)
    while left.any():
        odd = (left & _U(1)).astype(bool)
        out[odd] *= square
        left >>= _U(1)
        with np.errstate(over="ignore"):
            square = square * square
    return out


def group_starts(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def carried(batches: Iterator[pa.RecordBatch], key: str, take: Callable) -> Iterator[pa.RecordBatch]:
    """Call ``take(batch, starts, held)`` on each batch: where its groups start, and what it
    returned last if the first group goes on from there, else None."""
    last, held = None, None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy()
        out, held = take(batch, group_starts(keys), held if last is not None and keys[0] == last else None)
        last = keys[-1]
        yield out


def carry(stored: DataFrame, key: str, *sums: str) -> dict[int, tuple[int, list]]:
    """For each part, its first group and what the parts before hold of it.

    ``sums`` run along the group; those of the last row of a part are its total. One row a part.
    """
    last = F.max_by(F.struct(key, *sums), "line").alias("last")
    rows = stored.groupBy("part").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"), last)
    return {r.part: (r["first"], r["last"]) for r in rows.collect()}
