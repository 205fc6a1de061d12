"""Hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

#: Bytes that are hashed at once.
STEP = 1 << 18
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Multipliers of the mixing (odd, of no structure), and one start for each family of hashes.
_STEP, _ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = np.random.Generator(np.random.PCG64(41)).integers(0, 1 << 64, (2, 256), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """x, in its place, with every bit told from every other: each step can be undone, and none is linear in the one before."""
    x ^= x >> np.uint64(30)
    x *= _ONE
    x ^= x >> np.uint64(27)
    x *= _TWO
    x ^= x >> np.uint64(31)
    return x


def _step(raw: np.ndarray, family: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of some bytes."""
    inside = np.flatnonzero(~SPACE[raw])
    if not len(inside):
        return np.zeros(0, np.uint64), inside
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)  # of each word, among the bytes of words
    size, start = np.diff(first, append=len(inside)), inside[first]
    # a byte counts by itself and its place in the word, mixed, so that no pattern of places cancels out as in a polynomial
    value = (inside - np.repeat(start, size)).view(np.uint64)
    value *= _STEP
    value += _BYTE[family][raw[inside]]
    value = _mixed(value)
    return _mixed(np.add.reduceat(value, first) + size.astype(np.uint64)), start


def word_hashes(texts: list[bytes], family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts (runs of bytes that are no ASCII space), one text after the other, and for
    each text where its words end among them. The two families of hashes are independent of each other."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    stops = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    hashes, starts, at = [], [], 0
    while at < len(raw):
        size, to = STEP, len(raw)
        while at + size < len(raw):  # a step ends behind a space
            if len(last := np.flatnonzero(SPACE[raw[at : at + size]])):
                to = at + int(last[-1]) + 1
                break
            size *= 2
        h, start = _step(raw[at:to], family)
        hashes.append(h)
        starts.append(at + start)
        at = to
    flat, starts = np.concatenate(hashes), np.concatenate(starts)
    return flat, np.searchsorted(starts, stops)
