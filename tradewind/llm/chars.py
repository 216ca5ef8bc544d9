"""Hashed character n-grams of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20  # characters hashed at once, so that a very long text needs no more memory


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def ngram_ids(text: str | None, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Ids below ``2**bits`` of every n-gram of the lower-cased text, one array per order and block.

    Blocks overlap by ``n - 1`` characters, so that each n-gram comes once however long the text is.
    """
    if not text:
        return
    points, shift = code_points(text.lower()), np.uint32(32 - bits)
    longest = max(orders)
    for start in range(0, len(points), BLOCK):
        block = points[start : start + BLOCK + longest - 1]
        grams = block * np.uint32(0x85EBCA6B)
        for n in range(1, longest + 1):
            if n > 1:
                grams = (grams[:-1] ^ (grams[:-1] >> np.uint32(15))) * np.uint32(0x9E3779B1) + block[n - 1 :]
            if n in orders and len(grams):
                own = grams[: min(BLOCK, len(grams))]
                own = (own ^ np.uint32(n * 0x27D4EB2F)) * np.uint32(0xC2B2AE35)
                yield ((own ^ (own >> np.uint32(16))) * np.uint32(0x85EBCA6B)) >> shift


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)
