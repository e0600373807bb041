"""Hashes of words and word shingles, computed on the bytes of a text at once.

A word is a run of code points other than blank, tab, newline, vertical tab,
form feed and carriage return; A to Z count as lower case. Hashes have 64 bits
and do not depend on the process.
"""

import numpy as np

_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_CHUNK = 1 << 22


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def _words(data: np.ndarray, lower: bool) -> np.ndarray:
    gap = _SEPARATORS[data]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    letters = _LOWER[data] if lower else data
    np.cumsum(_BYTES[letters] * power[:-1], out=sums[1:])
    own = (sums[ends] - sums[starts]) * inverse[starts]
    return mixed(own + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    """The hash of every word of a UTF-8 text, in order; ``lower`` as said above."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= _CHUNK:
        return _words(data, lower)
    found, start = [], 0
    while start < len(data):
        end = min(start + _CHUNK, len(data))
        if end < len(data):
            gaps = np.flatnonzero(_SEPARATORS[data[start:end]])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
            else:  # one word of millions of bytes: up to its end at once
                while end < len(data) and not _SEPARATORS[data[end]]:
                    end += 1
        found.append(_words(data[start:end], lower))
        start = end
    return np.concatenate(found)


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """The different shingles of ``size`` words, ascending; of fewer words, all of them as one."""
    if not len(words):
        return words
    width = min(size, len(words))
    own = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        own = own * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - width + 1 + k]
    return np.unique(mixed(own))
