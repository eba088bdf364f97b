"""A bit table of fixed size that stands in for a set of ids in a first pass.

It never denies an id of the set. Where it is full it denies none, and a first pass
then sheds nothing: results stay the same, only more rows travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import mixed

#: Two places an id.
BITS = 2**25


def _places(x: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
    return mixed(x) % np.uint64(places), mixed(x ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(places)


def held(bits: np.ndarray, ids: np.ndarray, places: int = BITS) -> np.ndarray:
    """Which ids the table may hold."""
    out = np.ones(len(ids), bool)
    for x in _places(ids.view(np.uint64), places):
        out &= (bits.view(np.uint64)[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1) == 1
    return out


def table(ids: DataFrame, places: int = BITS) -> np.ndarray:
    """A table of so many bits with two set for each id (long, the only column). The driver gets its set words only, so a bounded number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(places // 64, np.uint64)
        for b in batches:
            for x in _places(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), places):
                np.bitwise_or.at(bits, (x >> np.uint64(6)).astype(np.int64), np.uint64(1) << (x & np.uint64(63)))
        word = np.flatnonzero(bits)
        for at in range(0, len(word), 100_000):
            part = word[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(bits[part].view(np.int64))], names=["word", "mask"])

    found = ids.mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(places // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return out
