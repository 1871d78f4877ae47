"""Words and shingles of a text as 64-bit hashes, alike in every operator that needs them.

A word is a run of anything but the six ASCII white-space characters, with A-Z lower-cased and
nothing else changed.  Hashes are computed for all words of a text at once: every byte has a random
64-bit value, and a word's hash is the sum of its bytes' values times powers of an odd number, taken
as a difference of running sums and moved to the word's start by the inverse power.
"""

from __future__ import annotations

import numpy as np

#: One word, as a regular expression.
WORD = r"[^\x20\x09-\x0D]+"

_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BLOCK = 1 << 20
_ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
_VALUE[65:91] = _VALUE[97:123]
_powers = np.ones(0, np.uint64), np.ones(0, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i up to n; grown to the longest block seen."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(2 * len(_powers[0]), n + 1, 1 << 14)
        _powers = tuple(np.cumprod(np.r_[_ONE, np.full(size, p, np.uint64)]) for p in (np.uint64(_P), np.uint64(pow(_P, -1, 1 << 64))))
    return _powers


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of all words of a text in order; none for null or white space."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(raw) <= _BLOCK:
        return _hash_block(raw)
    out, at = [], 0
    while at < len(raw):  # cut long texts at white space
        stop = at + _BLOCK
        if stop < len(raw):
            space = np.flatnonzero(_SPACE[raw[at:stop]])
            while not len(space) and stop < len(raw):
                space = np.flatnonzero(_SPACE[raw[stop : stop + _BLOCK]]) + (stop - at)
                stop += _BLOCK
            stop = at + int(space[-1]) + 1 if len(space) else len(raw)
        out.append(_hash_block(raw[at:stop]))
        at = stop
    return np.concatenate(out)


def _hash_block(raw: np.ndarray) -> np.ndarray:
    n = len(raw)
    power, inverse = _power_tables(n)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[raw], [True]))))
    starts, ends = edge[::2], edge[1::2]
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUE[raw] * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of ``width`` words; fewer words make one shingle of them all."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = hashes[: n - width + 1] + np.uint64(width)
    for i in range(1, width):
        out = mix(out * np.uint64(_P) + hashes[i : n - width + 1 + i])
    return out
