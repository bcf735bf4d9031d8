"""Bounds of samples and filters, without Spark."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from obsmill.llm import common, similar


def test_samples_stay_of_their_size_at_any_count():
    for n in (10, 10**6, 10**10, 10**15):
        assert common.hash_below(1000, n) / 2**63 * n == pytest.approx(min(n, 1000), rel=1e-6)


def test_bitmaps_differ_no_more_than_sets():
    rng = np.random.default_rng(6)
    for size in (5, 300):
        a, b = (np.unique(rng.integers(0, 2 * size, size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        for words in (similar.WORDS, similar.MORE_WORDS):
            bits = sum(int(x ^ y).bit_count() for x, y in zip(similar.bitmap(a, words).view(np.uint64), similar.bitmap(b, words).view(np.uint64), strict=True))
            assert bits <= len(np.setxor1d(a, b))
