"""Bloom filters set by Spark and probed by numpy.

A key is known by two 64-bit numbers. A filter's places are ``a + i * b`` over mixed halves of the two, so
filters of different ``salt`` err on different keys. Tasks turn their keys into (word, bits) rows, Spark joins the
bits of equal words, and only the filter, of at most ``MOST_BITS``, comes to the driver. More keys than that allows
make a filter err more often, never the other way; users of a filter have to stay right when it errs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mapped

MOST_BITS = 1 << 27
PROBED_AT_ONCE = 1 << 18

_ONE, _FIRST, _SECOND = np.uint64(1), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # mixing constants of murmur3


def mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """Spread 64-bit numbers evenly; another salt gives another spread."""
    turned = values.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 1) % (1 << 64))
    for factor in (_FIRST, _SECOND):
        turned = (turned ^ (turned >> np.uint64(33))) * factor
    return turned ^ (turned >> np.uint64(33))


class Bloom:
    def __init__(self, keys: int, bits_per_key: float, salt: int, most_bits: int = MOST_BITS, most_hashes: int = 16):
        size = min(most_bits, max(64, math.ceil(keys * bits_per_key)))
        self.words = np.zeros(math.ceil(size / 64), dtype=np.uint64)
        best = round(math.log(2) * 64 * len(self.words) / max(keys, 1))
        self.hashes = max(1, min(best, most_hashes)) if keys else 1
        self.salt = salt

    def _places(self, a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
        first, step = self._mixed(a, b)
        for number in range(self.hashes):
            yield self._place(first, step, number)

    def _mixed(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return mixed(a, 2 * self.salt), mixed(b, 2 * self.salt + 1) | _ONE

    def _place(self, first: np.ndarray, step: np.ndarray, number: int) -> np.ndarray:
        return (first + np.uint64(number) * step) % np.uint64(64 * len(self.words))

    def set(self, a: np.ndarray, b: np.ndarray) -> None:
        for places in self._places(a, b):
            np.bitwise_or.at(self.words, (places >> np.uint64(6)).astype(np.int64), _ONE << (places & np.uint64(63)))

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.zeros(len(a), dtype=bool)
        for start in range(0, len(a), PROBED_AT_ONCE):
            part = slice(start, start + PROBED_AT_ONCE)
            first, step = self._mixed(a[part], b[part])
            open_ = np.arange(start, start + len(first))
            for number in range(self.hashes):  # only keys that passed so far go on
                places = self._place(first, step, number)
                passed = (self.words[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63)) & _ONE) != 0
                if not passed.all():
                    first, step, open_ = first[passed], step[passed], open_[passed]
            found[open_] = True
        return found

    def _rows(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for places in self._places(a, b):
                words = (places >> np.uint64(6)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words), pa.array((_ONE << (places & np.uint64(63))).view(np.int64))], names=["word", "bits"]
                )


def of(
    frame: DataFrame, keys: int, bits_per_key: float, salt: int = 0, most_bits: int = MOST_BITS, most_hashes: int = 16
) -> Bloom:
    """The filter of all keys in a frame of two longs; ``keys`` is their number, counted before."""
    made = Bloom(keys, bits_per_key, salt, most_bits, most_hashes)
    if keys:
        rows = mapped(frame, made._rows, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        found = rows.toArrow()
        made.words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return made
