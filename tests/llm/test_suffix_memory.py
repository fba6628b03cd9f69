"""Strings are read from their places without a table of the places of their bytes."""

import tracemalloc

import numpy as np

from murmur.llm.deep_shallow import equal_groups


def test_memory_of_a_comparison():
    rows = np.random.default_rng(1).integers(97, 101, (20_000, 80), dtype=np.uint8)
    flat, start = np.concatenate([rows] * 5).ravel(), np.arange(100_000) * 80
    tracemalloc.start()
    at, group = equal_groups(flat, start, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(at) == 100_000 and len(np.unique(group)) == 20_000
    assert peak < 250 * len(start)
