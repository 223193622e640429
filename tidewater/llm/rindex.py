"""Run-length index of a repetitive text: a run-compressed Burrows-Wheeler
transform with sampled run ends, streamed for matching statistics.

The text is a list of parts, each ended by a mark of its own that sorts before
every byte (marks sort by their parts' places). Suffixes are sorted by doubled
prefixes up to their part's end. The transform is kept as runs: where each run's
rows begin, where its first row's predecessor lies, and the text position at its
last row. A repeat is a range of rows whose suffixes share ``length`` bytes; a
range keeps its earliest text position.

To stream the parts, each enters at its mark's row and goes backwards: a row's
predecessor is its run's first one plus the row's place in the run. Every step
reads the matching statistic at one text position as far as it matters: whether
the next ``length`` bytes also begin at an earlier one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Symbols that make up the first sort key: nine bits each, the mark among them.
PACKED = 7


class RunIndex(NamedTuple):
    start: np.ndarray  # first row of each run
    before: np.ndarray  # row of the suffix that is one byte longer than that of a run's first row
    sample: np.ndarray  # text position of the suffix at each run's last row
    low: np.ndarray  # ranges of rows that share the long prefix: first row,
    high: np.ndarray  # row after the last,
    earliest: np.ndarray  # least text position
    ends: np.ndarray  # text position of each part's mark
    sizes: np.ndarray  # bytes of each part
    length: int


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ascending order, rank of each key)."""
    order = np.argsort(keys)
    ordered = keys[order]
    step = ordered[1:] != ordered[:-1]
    del ordered
    order = order.astype(np.int32)
    ranks = np.zeros(len(keys), dtype=np.uint32)
    np.cumsum(step, out=ranks[1:])
    rank = np.empty(len(keys), dtype=np.uint32)
    rank[order] = ranks
    return order, rank


def build(parts: list[bytes], length: int) -> RunIndex:
    """Index of ``parts`` (none empty; less than 1 GB) with the repeats of ``length``
    bytes. Positions and ranks are kept as 32 bits, as a chunk is all a task holds."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    n = int(ends[-1]) + 1
    if n >= 1 << 30:
        raise ValueError("parts of an index must be less than 1 GB")
    text = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8).astype(np.int16) + 1
    text[ends] = 0
    end = np.repeat(ends.astype(np.int32), sizes + 1)  # of every position's part
    # The first symbols of each suffix, with nothing after its mark.
    key = np.zeros(n, dtype=np.uint64)
    at = np.arange(n, dtype=np.int32)
    for k in range(PACKED):
        key <<= np.uint64(9)
        key |= text[np.minimum(at + k, end)].astype(np.uint64)
    _, rank = _dense(key)
    rank += np.uint32(len(parts))
    rank[ends] = np.arange(len(parts), dtype=np.uint32)  # marks
    width, half, longest = PACKED, None, int(sizes.max()) + PACKED
    order = None
    while width < longest or order is None:
        if width <= length:
            half = (width, rank)  # the widest prefix within the length of a repeat
        key[:] = rank
        key <<= np.uint64(32)
        key |= rank[np.minimum(at + width, end)]
        order, rank = _dense(key)
        width *= 2
    del key
    # Neighbours that share the long prefix, by two overlapping shorter ones.
    width, rank = half
    whole = end - at >= length
    a, b = order[1:], order[:-1]
    second = length - width
    same = np.zeros(n, dtype=bool)
    same[1:] = whole[a] & whole[b] & (rank[a] == rank[b])
    near = np.flatnonzero(same)
    same[near] = rank[order[near] + second] == rank[order[near - 1] + second]
    low = np.flatnonzero(~same & np.append(same[1:], False))
    high = np.flatnonzero(same & ~np.append(same[1:], False)) + 1
    bounds = np.column_stack([low, high]).ravel()
    if len(bounds) and bounds[-1] == n:
        bounds = bounds[:-1]
    earliest = np.minimum.reduceat(order, bounds)[::2] if len(bounds) else np.zeros(0, dtype=np.int64)
    # The transform, its runs, and where their rows' predecessors lie.
    last = text[order - 1]
    new = np.ones(n, dtype=bool)
    new[1:] = last[1:] != last[:-1]
    start = np.flatnonzero(new)
    rows = np.diff(np.append(start, n))
    byte = last[start]
    by = np.argsort(byte, kind="stable")
    seen = np.cumsum(rows[by]) - rows[by]  # rows of smaller bytes, and of this one before
    before = np.empty(len(start), dtype=np.int64)
    before[by] = seen
    return RunIndex(start, before, order[start + rows - 1], low, high, earliest, ends, sizes, length)


def earlier(index: RunIndex) -> np.ndarray:
    """Text positions whose next ``length`` bytes begin at an earlier one too, in
    ascending order, by streaming all parts through the runs at once."""
    found = [np.zeros(0, dtype=np.int64)]
    if not len(index.low):
        return found[0]
    by_size = np.argsort(-index.sizes, kind="stable")
    row, at = by_size.copy(), index.ends[by_size]  # a part's mark is at the row of its place
    sizes = index.sizes[by_size]
    for step in range(1, int(sizes[0]) + 1):
        live = int(np.searchsorted(-sizes, -step, side="right"))
        row, at = row[:live], at[:live] - 1
        run = np.searchsorted(index.start, row, side="right") - 1
        row = index.before[run] + row - index.start[run]
        if step >= index.length:
            here = np.searchsorted(index.low, row, side="right") - 1
            hit = (here >= 0) & (row < index.high[here]) & (index.earliest[here] < at)
            found.append(at[hit])
    return np.sort(np.concatenate(found))
