"""Hashes of all words of a text at once."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)
RUN = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1
_SHIFT = np.uint64(31)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values * _MIX
    values ^= values >> _SHIFT
    values *= _FINAL
    return values ^ (values >> np.uint64(29))


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
# Longer words are hashed one by one.
_LANES = 8


def hashed_words(blob: bytes, white: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a text start, and two 64-bit hashes of each.

    Eight bytes are taken of all words at once, then the next eight of the longer ones.
    """
    padded = np.frombuffer(blob + bytes(8), np.uint8)
    word = np.zeros(len(blob) + 2, bool)
    word[1:-1] = ~white[padded[: len(blob)]]
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray((len(blob) + 1,), "<u8", padded.data, strides=(1,))
    first = lengths.astype(np.uint64) * np.uint64(RUN)
    second = ~first
    for lane in range(_LANES):
        some = np.flatnonzero(lengths > 8 * lane) if lane else slice(None)
        left = lengths[some] - 8 * lane
        if not len(left):
            break
        unused = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
        value = eights[starts[some] + 8 * lane] & (np.uint64(MASK) >> unused)
        first[some] = mixed(first[some] ^ value)
        second[some] = mixed(second[some] + value * np.uint64(RUN))
    for at in np.flatnonzero(lengths > 8 * _LANES).tolist():
        start = int(starts[at])
        both = xxhash.xxh3_128_intdigest(blob[start : start + int(lengths[at])])
        first[at], second[at] = both >> 64, both & MASK
    # 0 is the gap between texts.
    return starts, np.maximum(first, np.uint64(1)), second
