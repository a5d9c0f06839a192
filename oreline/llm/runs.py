"""Rows that arrive sorted by a key, in a Python task: slices of one key each, as a stream."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def slices(batches, names: list[str]):
    """Yield (key, batch): neighbouring rows whose (non-null) columns ``names`` are equal. A long run comes in several slices."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        fresh = np.zeros(batch.num_rows, bool)
        fresh[0] = True
        for k in keys:
            fresh[1:] |= k[1:] != k[:-1]
        at = np.append(np.flatnonzero(fresh), batch.num_rows)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield tuple(k[a].item() for k in keys), batch.slice(a, b - a)


def whole(batches, names: list[str]):
    """Yield (key, table) with all rows of a key; for keys whose number of rows is bounded."""
    have, parts = None, []
    for key, part in slices(batches, names):
        if key != have and parts:
            yield have, pa.Table.from_batches(parts).combine_chunks()
            parts = []
        have = key
        parts.append(part)
    if parts:
        yield have, pa.Table.from_batches(parts).combine_chunks()
