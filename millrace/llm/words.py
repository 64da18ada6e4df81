"""Words of many texts at once: positions, hashes and windows, in numpy.

A word is a run of bytes outside the six ASCII white-space characters. Texts lie end to
end in one buffer and are taken in ranges of bounded size, cut between words, so a text
of any length needs memory for its word hashes only.
"""

from __future__ import annotations

import numpy as np

RANGE = 1 << 18
WINDOW = 5
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def _range_end(data: np.ndarray, offsets: np.ndarray, start: int, size: int) -> int:
    """The end of a range from ``start``: at a text's end, or ahead of white space."""
    end = start + size
    if end >= len(data):
        return len(data)
    limit = int(offsets[np.searchsorted(offsets, end)])
    while end < limit and IN_WORD[data[end]]:
        out = np.flatnonzero(~IN_WORD[data[end : min(end + RANGE, limit)]])
        if len(out):
            return end + int(out[0])
        end = min(end + RANGE, limit)
    return end


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, fold: bool = False, size: int = RANGE
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the bounds of each text in them.

    ``fold`` lower-cases A to Z.
    """
    letters = LOWER if fold else AS_IS
    all_starts, all_hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    start = 0
    while start < len(data):
        end = _range_end(data, offsets, start, size)
        part = data[start:end]
        word = IN_WORD[part]
        fresh = offsets[np.searchsorted(offsets, start, "right") : np.searchsorted(offsets, end)] - start
        first = word.copy()
        first[1:] &= ~word[:-1]
        first[fresh] = word[fresh]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[fresh - 1] = word[fresh - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, inverse = _power_tables(max(len(part), size))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((letters[part].astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * inverse[starts]
        all_hashes.append(mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        all_starts.append(starts + start)
        start = end
    return np.concatenate(all_hashes), np.searchsorted(np.concatenate(all_starts), offsets)


def window_hashes(words: np.ndarray, n: int = WINDOW) -> np.ndarray:
    """Hashes of ``n`` words in a row at every start; those across texts have no meaning."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = total * np.uint64(_MULTIPLIER) + words[k : len(words) - n + 1 + k]
    return mix(total + np.uint64(n))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = WINDOW) -> list[np.ndarray]:
    """The sorted distinct window hashes of each text, A to Z lower-cased.

    A text of fewer than ``n`` words has its whole sequence as its one window; a text
    without words has none.
    """
    words, bounds = word_hashes(data, offsets, fold=True)
    windows = window_hashes(words, n)
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low >= n:
            out.append(np.unique(windows[low : high - n + 1]))
        else:
            out.append(window_hashes(words[low:high], high - low) if high > low else words[:0])
    return out
