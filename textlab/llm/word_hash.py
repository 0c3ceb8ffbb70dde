"""Words of many texts at once: their places and 64-bit hashes as flat arrays.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
Sums wrap around at 2^64, and the base is odd, so the hash of any run of words comes from two prefix sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from textlab.llm.workers import flat_bytes

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_WORD_BASE_INVERSE = pow(_WORD_BASE, -1, 1 << 64)


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[: max(count, 1)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits, so that minima and equal parts of hashes behave as random."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    starts: np.ndarray  # byte places in the flat texts
    ends: np.ndarray
    first: np.ndarray  # index of the first word of each text, and the number of all words
    hashes: np.ndarray
    offsets: np.ndarray  # byte offsets of the texts


def find_words(column: pa.Array, hashes: bool = True) -> Words:
    data, offsets = flat_bytes(column)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[1:], before[0] = inside[:-1], False
        after[:-1], after[-1] = inside[1:], False
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    found = np.zeros(0, np.uint64)
    if hashes and len(starts):
        lengths = ends - starts
        at = np.cumsum(lengths) - lengths
        letters = data[inside].astype(np.uint64) + np.uint64(1)
        place = np.arange(len(letters)) - np.repeat(at, lengths)
        found = mixed(np.add.reduceat(letters * powers(_BYTE_BASE, int(lengths.max()))[place], at))
    return Words(starts, ends, first, found, offsets)


class Runs:
    """Hash of any run of words `[start, end)` in constant time."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(_WORD_BASE, len(hashes)), dtype=np.uint64)]) if len(hashes) else np.zeros(1, np.uint64)
        self.back = powers(_WORD_BASE_INVERSE, len(hashes) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row."""
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:-rest], out[rest:]) if rest else out
