"""Texts as arrays of code points, several texts in one array."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


@lru_cache(maxsize=2)
def plane(kind: str) -> np.ndarray:
    """For each code point whether ``str.<kind>()`` holds."""
    return np.array([getattr(chr(c), kind)() for c in range(0x110000)])


def holds(kind: str, codes: np.ndarray) -> np.ndarray:
    """``str.<kind>()`` of each code point."""
    return plane(kind)[codes]


def lowered(text: str) -> str:
    """Lower case with as many code points as before (U+0130 alone would give two)."""
    return text.replace("İ", "i").lower()


def code_points(texts: list[str], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in lower case with ``gap`` zeros after each, and where each begins (one more at the end)."""
    joint = "".join(lowered(t) + "\0" * gap for t in texts)
    starts = np.concatenate([[0], np.cumsum([len(t) + gap for t in texts])]).astype(np.int64)
    return np.frombuffer(joint.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), starts


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each run of ``q`` code points."""
    n = max(0, len(codes) - q + 1)
    value = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(q):
            value = value * np.uint64(0x9E3779B97F4A7C15) + codes[k:n + k].astype(np.uint64) + np.uint64(1)
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
    return value


def byte_grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each run of ``q`` (8 at most) code points by their low bytes; equal runs have equal hashes."""
    n = max(0, len(codes) - q + 1)
    low = np.zeros(len(codes) + 8, dtype=np.uint8)
    low[:len(codes)] = codes
    runs = np.ndarray((n,), dtype="<u8", buffer=low, strides=(1,)) & np.uint64((1 << 8 * q) - 1)
    with np.errstate(over="ignore"):
        return runs * np.uint64(0x9E3779B97F4A7C15)


def in_groups(texts: list[str], limit: int = 1 << 20):
    """(from, to) of runs of texts with about ``limit`` characters."""
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) < limit:
            size, to = size + len(texts[to]), to + 1
        yield at, to
        at = to
