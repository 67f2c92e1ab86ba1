"""Words of Arrow batches as 64-bit hashes, and rolling hashes over them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

# Texts that are hashed together, in bytes. A longer text is hashed by itself.
CHUNK = 2 << 20
# Odd multipliers of the rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Chunk:
    """The words of rows `begin` to `begin + len(counts)` of a batch, one text after the other."""

    begin: int
    words: list[bytes]
    counts: np.ndarray

    def hashes(self) -> np.ndarray:
        if not self.words:
            return np.zeros(0, np.uint64)
        return pd.util.hash_array(np.array(self.words, dtype=object), categorize=False)

    def owners(self) -> np.ndarray:
        """For each word the row of the chunk that it belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def chunks(texts: pa.Array, lower: bool = False) -> Iterator[Chunk]:
    """All texts of a batch, in order; NULL has no words. With `lower`, A-Z become a-z."""
    begin, size, words, counts = 0, 0, [], []
    for i, value in enumerate(texts):
        text = (value.as_py() or "").encode()
        # Bytes are split at space and tab to carriage return, nothing else.
        own = (text.lower() if lower else text).split()
        words += own
        counts.append(len(own))
        size += len(text)
        if size >= CHUNK:
            yield Chunk(begin, words, np.array(counts, np.int64))
            begin, size, words, counts = i + 1, 0, [], []
    if counts:
        yield Chunk(begin, words, np.array(counts, np.int64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values after which all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_known_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least `size` powers of a base and of its inverse; the worker keeps the longest so far."""
    known = _known_powers.get(base)
    if known is not None and len(known[0]) >= size:
        return known
    size = max(1 << 16, 1 << size.bit_length())
    steps = [np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
    for step in steps:
        step[0] = 1
    _known_powers[base] = (np.cumprod(steps[0], dtype=np.uint64), np.cumprod(steps[1], dtype=np.uint64))
    return _known_powers[base]


def rolling(x: np.ndarray, width: int, base: int = BASES[0]) -> np.ndarray:
    """A hash of every run of `width` values, modulo 2**64; equal runs have equal hashes."""
    if len(x) < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, len(x))
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * up[: len(x)], out=sums[1:])
    return (sums[width:] - sums[:-width]) * down[: len(x) - width + 1]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x
