"""The counting quotient filter against a plain counter."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from murmur.llm.quotient import CountingQuotientFilter, decoded, encoded, merged


def content(f):
    keys, counts = f.items()
    assert keys.tolist() == sorted(keys.tolist())
    return dict(zip(keys.tolist(), counts.tolist(), strict=True))


@pytest.mark.parametrize("r", [2, 3, 8])
def test_counts_in_a_run(r):
    for x in range(min(1 << r, 12)):
        for n in [*range(1, 80), 10**6]:
            slots = encoded(x, n, r)
            assert all(0 <= s < 1 << r for s in slots)
            assert decoded(slots, r) == [(x, n)]


def test_runs_of_all_neighbours():
    """A zero that begins the digits of another remainder isn't taken for the end of a count of zero."""
    for n in range(1, 9):
        for m in range(1, 9):
            run = encoded(0, n, 3) + encoded(1, m, 3) + encoded(7, n, 3)
            assert decoded(run, 3) == [(0, n), (1, m), (7, n)]


@settings(max_examples=150, deadline=None)
@given(
    st.sampled_from([3, 6, 12, 40, 64]),
    st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=60), max_size=4),
    st.sampled_from([2, 5, 64]),
    st.integers(0, 400),
)
def test_merge_loses_nothing(bits, groups, narrow, repeats):
    groups = [[x % 2 ** min(bits, narrow) for x in g] for g in groups]
    if groups and groups[0]:
        groups[0] += groups[0][:1] * repeats
    filters = [CountingQuotientFilter.of(np.array(g, np.uint64), bits) for g in groups]
    stored = [CountingQuotientFilter.from_bytes(f.to_bytes()) for f in filters]
    for f, g in zip(stored, groups, strict=True):
        assert content(f) == Counter(g)
    whole = merged(stored, bits)
    want = Counter(x for g in groups for x in g)
    assert content(whole) == want
    for x in [*list(want)[:5], 0, 2**bits - 1]:
        assert whole.count(x) == want.get(x, 0)
