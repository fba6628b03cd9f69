"""Sets of hashed word shingles, computed for many texts at once.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z in lower case. A text with fewer words than
a shingle holds has its whole sequence as one shingle; a text without words has none.
"""

from __future__ import annotations

import functools

import numpy as np

from murmur.llm.common import mix

BYTES_AT_ONCE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first position of each word of a text in bytes."""
    gap = SPACE[raw]
    word = ~gap
    start = np.flatnonzero(word & np.append(True, gap[:-1]))
    end = np.flatnonzero(word & np.append(gap[1:], True)) + 1
    size = 1 << max(16, (len(raw) - 1).bit_length())
    up, down = _powers(max(size, 2 * BYTES_AT_ONCE))
    # what a word adds to the running sum, brought back to the word's own start
    sums = np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)])
    before = np.where(start > 0, sums[start - 1], np.uint64(0))
    return mix((sums[end - 1] - before) * down[start]), start


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, or of all where there are fewer."""
    n = len(words)
    width = min(k, n)
    if not n:
        return words
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : n - width + 1 + i]
    return mix(out)


def sets(items: list[str], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    raw = [x.encode("utf-8", "surrogatepass") for x in items]
    i = 0
    while i < len(raw):
        j, total = i, 0
        while j < len(raw) and (j == i or total + len(raw[j]) < BYTES_AT_ONCE):
            total += len(raw[j]) + 1
            j += 1
        joined = np.frombuffer(b"\n".join(raw[i:j]) + b"\n", np.uint8)
        words, start = word_hashes(joined)
        ends = np.cumsum([len(x) + 1 for x in raw[i:j]])
        cuts = np.searchsorted(start, ends).tolist()
        a = 0
        for b in cuts:
            out.append(np.unique(shingle_hashes(words[a:b], k)))
            a = b
        i = j
    return out
