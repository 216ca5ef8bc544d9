"""Words of UTF-8 texts as 64-bit numbers, a block of texts at a time, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20  # bytes hashed at once; a longer text is cut at white space
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: A-Z become a-z; words are split at \\x20 and \\x09-\\x0D, which in UTF-8 are never part of another character.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.full(n - 1, base))).cumprod(dtype=np.uint64)


_UP, _DOWN = _powers(BLOCK + 1, _BASE), _powers(BLOCK + 1, _INVERSE)


def _block_words(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one run of bytes, in order."""
    global _UP, _DOWN
    if len(data) >= len(_UP):  # one word longer than a block
        _UP, _DOWN = _powers(len(data) + 1, _BASE), _powers(len(data) + 1, _INVERSE)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _UP[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _DOWN[starts])


def _text_words(data: np.ndarray) -> np.ndarray:
    parts, start = [], 0
    while start < len(data):
        end = start + BLOCK
        if end < len(data):
            gap = np.flatnonzero(_SPACE[data[start:end]])
            if len(gap):
                end = start + int(gap[-1]) + 1
            else:  # go on to the next white space
                rest = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(data)
        parts.append(_block_words(data[start:end]))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words, text by text; NULL has none. Texts of a block are hashed together."""
    column = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK // 2, "right")) - 1)
        if last == first + 1:
            yield _text_words(data[offsets[first] : offsets[last]])
        else:
            # One space between texts keeps the last word of one and the first of the next apart.
            lengths = np.diff(offsets[first : last + 1])
            joined = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
            shift = np.repeat(np.arange(len(lengths)), lengths)
            joined[np.arange(len(shift)) + shift] = data[offsets[first] : offsets[last]]
            space = _SPACE[joined]
            begins = np.concatenate(([0], np.cumsum(np.diff(space.view(np.int8)) == -1))) + (0 if space[0] else 1)
            # begins[i]: words that begin at or before byte i
            hashes = _block_words(joined)
            ends = np.cumsum(lengths + 1) - 1
            yield from np.split(hashes, begins[ends[:-1]])
        first = last


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; a shorter text is one run; no word, no run."""
    return np.unique(runs(words, size))


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words in order; a text with fewer words is one run of all of them."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        out = out * _BASE + words[i : len(words) - size + 1 + i]
    return mixed(out)
