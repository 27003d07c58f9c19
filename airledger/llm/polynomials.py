"""Prefix polynomials of a text, from which every part of it has its fingerprint (Rabin and Karp)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Primes below 2^31 with the bases of their polynomials: products fit 64 bits.
FIELDS = ((2147483647, 1103515245), (2147483629, 742938285), (2147483587, 1588635695), (2147483579, 950706376))


def powers(base: int, prime: int, size: int) -> np.ndarray:
    out = np.ones(size, dtype=np.uint64)
    done = 1
    while done < size:
        step = np.uint64(pow(base, done, prime))
        out[done : 2 * done] = out[:done][: size - done] * step % np.uint64(prime)
        done *= 2
    return out


@lru_cache(maxsize=4)
def _table(field: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    prime, base = FIELDS[field]
    return powers(base, prime, size), powers(pow(base, -1, prime), prime, size)


REMEMBERED = 1 << 19


class Prefixes:
    """The polynomial in one field of every start of ``codes`` (numbers over 0)."""

    def __init__(self, codes: np.ndarray, field: int):
        size = len(codes) + 1
        self.prime = np.uint64(FIELDS[field][0])
        up, down = _table(field, REMEMBERED) if size <= REMEMBERED else _table.__wrapped__(field, size)
        self.up, self.down = up[:size], down[:size]
        terms = codes.astype(np.uint64) * self.up[:-1] % self.prime
        self.before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms))) % self.prime

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The polynomials of ``codes[start:end]``, whatever their place."""
        return (self.before[end] + self.prime - self.before[start]) % self.prime * self.down[start] % self.prime
