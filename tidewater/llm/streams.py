"""Rows of one key after another, in a mapInArrow task over sorted input."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the consecutive rows that agree on ``key`` (never null). Only the
    rows of one key are held at a time."""
    held: list[pa.RecordBatch] = []
    value = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key)
        change = pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(int(i) + 1 for i in change.nonzero()[0]), len(k)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = k[a].as_py()
            if held and now != value:
                yield pa.Table.from_batches(held)
                held = []
            value = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
