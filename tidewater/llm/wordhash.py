"""Words and their 64-bit hashes over a block of texts, in numpy.

Words are maximal runs of characters other than space and \\x09-\\x0D, after
lower-casing A-Z. These separators are ASCII, so the scan works on UTF-8 bytes.
A word's hash is a polynomial in its bytes (each byte replaced by a fixed random
64-bit value), read off a prefix sum, then finalised; it depends on the word
alone, never on its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: Bytes of text hashed at a time; a longer single text makes a longer block.
BLOCK_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


#: ASCII bytes between words.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def flags(of: bytes) -> np.ndarray:
    """A table of 256 booleans that marks the bytes in ``of``."""
    table = np.zeros(256, dtype=bool)
    table[list(of)] = True
    return table


def _tables(n: int, separators: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if "byte" not in _TABLES:
        _TABLES["byte"] = constants(7, 256)
    if "up" not in _TABLES or len(_TABLES["up"]) < n:
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, n), _powers(_BASE_INV, n)
    return flags(separators), _TABLES["byte"], _TABLES["up"][:n], _TABLES["down"][:n]


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Words(NamedTuple):
    """Words of a block of texts. Text ``i`` owns words ``bounds[i]:bounds[i + 1]``."""

    data: np.ndarray  # the block's bytes
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    bounds: np.ndarray
    prefix: np.ndarray  # prefix sums of the byte polynomial
    down: np.ndarray  # inverse powers of the base

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """Hash of every word, or of its first ``longest`` bytes."""
        end = self.end if longest is None else np.minimum(self.end, self.start + longest)
        with np.errstate(over="ignore"):
            return mix((self.prefix[end] - self.prefix[self.start]) * self.down[self.start])


def words(texts: list[str | None], separators: bytes = SPACES) -> Words:
    """Words of one block of texts (null: none). ``separators`` are ASCII bytes, the
    space among them."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer((b" ".join(raw) + b" ").translate(_LOWER), dtype=np.uint8)
    sep, value, up, down = _tables(len(data) + 1, separators)
    inside = ~sep[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    starts_of_text = np.cumsum([0, *(len(r) + 1 for r in raw)])
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(value[data] * up[: len(data)], out=prefix[1:])
    return Words(data, start, end, np.searchsorted(start, starts_of_text), prefix, down)


def blocks(texts: list[str | None], most: int = BLOCK_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """Cut a batch of texts into blocks of about ``most`` bytes, with their offsets."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]
