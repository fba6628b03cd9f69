"""Deep-shallow sorting of byte strings of one length, many at once.

Multikey quicksort orders the strings to a shallow depth, eight bytes as one key, and leaves
behind what is alone in its group. Groups that still agree go into blind tries: a node
keeps only the depth at which its strings first differ and the byte each has there; the
strings below it are told apart by that byte, and compared in full only with their group's first
string. All tries grow together, one level at a time.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

SHALLOW = 16


def _starts(group: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, group[1:] != group[:-1]))


def _regroup(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, key) and the new group of each string in that order."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    return order, np.cumsum(np.append(False, (g[1:] != g[:-1]) | (k[1:] != k[:-1])))


def equal_groups(flat: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings ``flat[s : s + length]`` that have an equal, as indices into ``start``, and their group.

    Both come in the order of the strings, so equal ones stand together. Strings that equal no other are
    left out as soon as they are alone.
    """
    at = np.arange(len(start))
    group = np.zeros(len(start), np.int64)
    for depth in range(0, min(SHALLOW, length) - 7, 8):
        if not len(at):
            return at, group
        key = sliding_window_view(flat, 8)[start[at] + depth].view(">u8").ravel()
        order, group = _regroup(group, key)
        at = at[order]
        size = np.diff(np.append(_starts(group), len(group)))
        keep = np.repeat(size > 1, size)
        at, group = at[keep], group[keep]
    return _blind_tries(flat, start, length, at, group)


def _blind_tries(flat, start, length, at, group):
    done_at, done_group = [], []
    base = 0
    depth = np.full(len(at), min(SHALLOW, length) // 8 * 8 if length >= 8 else 0)
    while len(at):
        first = _starts(group)
        size = np.diff(np.append(first, len(group)))
        least = min(int(depth.min()), length - 1)
        rest = sliding_window_view(flat, length)[start[at], least:]
        differs = rest != np.repeat(rest[first], size, axis=0)
        place = np.where(differs.any(axis=1), differs.argmax(axis=1), length - least)
        branch = np.repeat(np.minimum.reduceat(place, first), size) + least
        whole = branch == length
        if whole.any():
            done_at.append(at[whole])
            done_group.append(group[whole] + base)
        ids = int(group.max()) + 1
        at, group, branch = at[~whole], group[~whole], branch[~whole]
        if not len(at):
            break
        order, fresh = _regroup(group, flat[start[at] + branch])
        at, depth = at[order], branch[order] + 1
        size = np.diff(np.append(_starts(fresh), len(fresh)))
        keep = np.repeat(size > 1, size)
        base += ids
        at, group, depth = at[keep], fresh[keep], depth[keep]
    if not done_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(done_at), np.concatenate(done_group)
