"""Groups of rows that arrive sorted by a key, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches, key: str) -> Iterator[pa.Table]:
    """One table per run of equal keys (whole numbers); a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(b.schema.get_field_index(key)).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if held and keys[i] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = keys[i]
    if held:
        yield pa.Table.from_batches(held)
