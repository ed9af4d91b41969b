"""64-bit hashing of words and word runs with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def words_in(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8. ``bytes.split`` parts at just the six spaces that end words."""
    return text.encode().split() if text else []


class Runs:
    """Hashes of runs of a sequence, any length, from one pass of prefix sums (modulo 2^64)."""

    def __init__(self, units: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        n = len(units)
        with np.errstate(over="ignore"):
            powers = np.full(n + 1, base | 1, np.uint64)
            powers[0] = 1
            self._powers = np.multiply.accumulate(powers)
            inverse = np.uint64(pow(base | 1, -1, 1 << 64))
            back = np.full(n + 1, inverse, np.uint64)
            back[0] = 1
            self._back = np.multiply.accumulate(back)
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(units * self._powers[:n], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._sums[ends] - self._sums[starts]) * self._back[starts])


def run_hashes(units: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes, 128 bits together, of the runs of that length."""
    bases = (0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5)
    return tuple(Runs(units, b).hashes(starts, starts + length).view(np.int64) for b in bases)


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every ``width`` neighbours, by doubling."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = best(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def winnowed(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions of grams that are least among some ``width`` neighbours: equal sequences of
    ``width`` grams choose equal places."""
    if len(grams) < width:
        return np.empty(0, np.int64)
    least = sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    reached = sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(reached == grams)
