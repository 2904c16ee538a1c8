"""Words and hashes of many texts at once, on their UTF-8 bytes.

Words are runs of bytes other than ASCII white space (0x20 and 0x09 to 0x0D), so no character is
ever cut. All hashes are 64 bits and the same on every machine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Odd numbers with well-spread bits; any would do, but results depend on them.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
STEP = np.uint64(0xA0761D6478BD642F)
SEED = 20240611

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * MIX
    values = (values ^ (values >> np.uint64(29))) * STEP
    return values ^ (values >> np.uint64(32))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**64, 256, np.uint64, endpoint=False)


@lru_cache(2)
def _powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(count, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)


def _table(base: int, count: int) -> np.ndarray:
    """At least ``count`` powers of ``base``, in sizes that double, so that few are made."""
    return _powers(base, 1 << max(16, (count - 1).bit_length()))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the number of words before each text, and in all."""
    inside = ~BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    begins = np.flatnonzero(begin)
    return begins, np.flatnonzero(end) + 1, np.searchsorted(begins, offsets)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word: its bytes' values times powers of a base, summed by differences."""
    base = int(BASE)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * _table(base, len(data) + 1)[: len(data)], out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return mixed((sums[ends] - sums[begins]) * _table(inverse, len(data) + 1)[begins])


def distinct(values: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The distinct values of each text, ascending."""
    found = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        row = np.sort(values[a:b])
        found.append(row[np.concatenate([[True], row[1:] != row[:-1]])] if len(row) else row)
    return found


def shingle_hashes(
    words: np.ndarray, bounds: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` neighbouring words, and the number of them before each text.

    A text of fewer words has its whole sequence as the only one; one without words has none.
    """
    counts = np.diff(bounds)
    rows = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(rows)])
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    sums = np.zeros(len(words), np.uint64)
    short = counts < width
    for ahead in range(width):
        moved = np.zeros(len(words), np.uint64)
        moved[: len(words) - ahead] = words[ahead:]
        sums = mixed(sums * BASE + moved + STEP)
    firsts = np.repeat(bounds[:-1], rows) + np.arange(out[-1]) - np.repeat(out[:-1], rows)
    hashes = sums[firsts]
    for at in np.flatnonzero(short & (counts > 0)):
        whole = counts[at : at + 1].astype(np.uint64)
        for word in words[bounds[at] : bounds[at + 1]]:
            whole = mixed(whole * BASE + word + MIX)
        hashes[out[at]] = whole[0]
    return hashes, out
