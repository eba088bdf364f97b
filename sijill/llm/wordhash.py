"""Words of many texts at once, with their places and 64-bit hashes, as arrays.

Hashes are polynomials modulo 2**64 over mixed code points, taken from running sums, so
the cost is a few vector operations a character whatever the words are. They are the
same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
#: Characters that one step works on at least; a longer text is a step of its own.
STEP = 250_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits; one to one."""
    x = (x + _ODD) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, STEP + 50_000), base, np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
        if n > 4 * STEP:  # do not hold on to the tables of one very long text
            return _powers.pop(base)[:n]
    return _powers[base][:n]


def spans(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of 64-bit values, in order; spans of other lengths differ."""
    n = len(values) + 1
    sums = np.zeros(n, np.uint64)
    np.cumsum(values * _power(_BASE, n)[:-1], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * _power(_INVERSE, n)[begin] + (end - begin).astype(np.uint64) * _ODD)


def _lower(full: bool) -> np.ndarray:
    table = np.arange(0x10000, dtype=np.uint32)
    if full:
        for i in range(0x10000):
            low = chr(i).lower()
            if len(low) == 1:
                table[i] = ord(low)
    else:
        table[65:91] += 32
    return table


_lowers: dict[bool, np.ndarray] = {}


@dataclass
class Words:
    """codes: all texts, each after a line feed. Per word: its text, begin, end (places in codes) and hash. first: each text's place in codes."""

    codes: np.ndarray
    first: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def words(texts: list[str], full: bool) -> Words:
    """full: fold the case of all letters, else of A-Z only."""
    if full not in _lowers:
        _lowers[full] = _lower(full)
    codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(size + 1) - size
    inside = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    table = _lowers[full]
    low = np.where(codes < 0x10000, table[np.minimum(codes, 0xFFFF)], codes)
    return Words(codes, first, np.searchsorted(first, begin, "right") - 1, begin, end, spans(mixed(low.astype(np.uint64)), begin, end))


def in_steps(texts: pa.Array | list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Slices of a column of about STEP characters, with the place of the first; null counts as ''. Only a slice is held as strings."""
    at, part, size = 0, [], 0
    for low in range(0, len(texts), 64):
        few = texts[low : low + 64]
        for i, x in enumerate(few if isinstance(few, list) else few.to_pylist(), low):
            part.append(x or "")
            size += len(part[-1])
            if size >= STEP:
                yield at, part
                at, part, size = i + 1, [], 0
    if part:
        yield at, part
