"""Vectorised views of texts as numpy arrays: blocks of documents, word bounds, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def blocks(texts: list, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents of about ``size`` characters; a longer document is a range alone."""
    lo = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def joined(texts: list[bytes], gap: int = 1, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, each after ``gap`` spaces, and the place where each begins."""
    pad = b" " * gap
    buf = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    starts = gap + np.cumsum([0, *[len(t) + gap for t in texts[:-1]]]) if texts else np.zeros(0, np.int64)
    return (_LOWER[buf] if lower else buf), starts.astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK + (1 << 16))
        inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
        for name, base in (("up", _PRIME), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; the array begins and ends with a space."""
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    return edge[0::2], edge[1::2]


def word_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words from one polynomial prefix sum, so that no word is touched by Python."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin])
