"""Counting quotient filter: how often each fingerprint occurs, exactly for the fingerprint's bits.

A fingerprint of q + r bits is split into a quotient of q bits, which names a home slot, and a remainder of r bits, which
is stored in a slot there or in the next free ones. Remainders of one quotient form a run in ascending order; one bit per
slot says that the quotient has a run, another that a run ends there, so the k-th quotient with a run owns the k-th end. A
count is written into the run itself, behind its remainder x:

* 1 is ``x``, 2 is ``x x``;
* more, x > 0, is ``x digits x``: the digits are neither 0 nor x and begin under x, if need be with a 0 before them;
* more, x = 0, is ``0 0 0`` for 3 and ``0 digits 0 0`` beyond, with digits that aren't 0.

Filters are built from sorted fingerprints and read in sorted order, so any number of them merge without loss: remainders
of equal quotients meet in order and their counts add up.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

LOAD = 0.9  # of the slots, at most, when a filter is built


def _digits(number: int, base: int) -> list[int]:
    out = []
    while number:
        number, d = divmod(number, base)
        out.append(d)
    return out[::-1]


def encoded(x: int, count: int, r: int) -> list[int]:
    """Slots of one remainder and its count; ``r`` is its width and 2 at least."""
    if count <= 2:
        return [x] * count
    top = 1 << r
    if x == 0:
        if count == 3:
            return [0, 0, 0]
        # digits 1 .. top - 1, the number of times beyond 4 and a leading 1 so that zero has digits too
        body = [d + 1 for d in _digits(count - 4, top - 1)] or [1]
        return [0, *body, 0, 0]
    # digits are 1 .. top - 1 without x
    body = [d + 1 if d + 1 < x else d + 2 for d in _digits(count - 3, top - 2)] or [1 if x > 1 else 2]
    return [x, *([0] if body[0] >= x else []), *body, x]


def decoded(slots: list[int], r: int) -> list[tuple[int, int]]:
    """(remainder, count) of a run."""
    out, i, n, top = [], 0, len(slots), 1 << r
    while i < n:
        x = slots[i]
        if i + 1 == n or slots[i + 1] > x and x > 0:
            out.append((x, 1))
            i += 1
        elif x > 0 and slots[i + 1] == x:
            out.append((x, 2))
            i += 2
        elif x > 0:
            stop = slots.index(x, i + 1)
            number = 0
            for d in slots[i + 1 : stop]:
                if d:
                    number = number * (top - 2) + (d - 1 if d < x else d - 2)
            out.append((x, number + 3))
            i = stop + 1
        else:
            # two zeros end a count of 0; a single one begins the digits of another remainder
            stop = next((j for j in range(i + 1, n) if slots[j] == 0), n)
            if stop > i + 1 and slots[stop : stop + 2] != [0, 0]:
                out.append((0, 1))
                i += 1
            elif stop == i + 1:
                three = stop + 1 < n and slots[stop + 1] == 0
                out.append((0, 3 if three else 2))
                i = stop + 1 + three
            else:
                number = 0
                for d in slots[i + 1 : stop]:
                    number = number * (top - 1) + d - 1
                out.append((0, number + 4))
                i = stop + 2
    return out


class CountingQuotientFilter:
    """Fingerprints of ``bits`` bits with their counts; the number of quotients follows from the number of slots."""

    def __init__(self, bits: int, q: int, occupied: np.ndarray, ends: np.ndarray, slots: np.ndarray):
        self.bits, self.q, self.r = bits, q, bits - q
        self.occupied, self.ends, self.slots = occupied, ends, slots

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """From different fingerprints (unsigned 64 bits) in ascending order and their counts."""
        keys, counts = keys.astype(np.uint64), counts.astype(np.int64)
        # three slots or more for what occurs more than twice; wide remainders need no more than five
        need = int(np.minimum(counts, 5).sum())
        q = max(0, min(bits - 2, int(np.ceil(np.log2(max(1, need) / LOAD)))))
        r = bits - q
        quotient = (keys >> np.uint64(r)).astype(np.int64) if r < 64 else np.zeros(len(keys), np.int64)
        rest = keys & np.uint64((1 << r) - 1)
        width = np.where(counts <= 2, counts, 0)
        many = np.flatnonzero(counts > 2)
        extra = [encoded(int(rest[i]), int(counts[i]), r) for i in many.tolist()]
        width[many] = [len(x) for x in extra]
        flat = np.repeat(rest, width)
        first = np.cumsum(width) - width
        for i, x in zip(many.tolist(), extra, strict=True):
            flat[first[i] : first[i] + len(x)] = np.array(x, np.uint64)
        new = np.flatnonzero(np.append(True, quotient[1:] != quotient[:-1])) if len(keys) else np.zeros(0, np.int64)
        home = quotient[new]
        at = first[new]  # slots used before the run
        length = np.diff(np.append(at, len(flat)))
        start = np.maximum.accumulate(home - at) + at if len(new) else at
        size = max(1 << q, int(start[-1] + length[-1]) if len(new) else 0)
        occupied, ends, slots = np.zeros(1 << q, bool), np.zeros(size, bool), np.zeros(size, np.uint64)
        occupied[home] = True
        ends[start + length - 1] = True
        slots[np.repeat(start - at, length) + np.arange(len(flat))] = flat
        return cls(bits, q, occupied, ends, slots)

    @classmethod
    def of(cls, fingerprints: np.ndarray, bits: int) -> CountingQuotientFilter:
        """From fingerprints in any order, repeats included."""
        return cls.build(*np.unique(fingerprints.astype(np.uint64), return_counts=True), bits)

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Quotient, first and last slot of each run."""
        home, last = np.flatnonzero(self.occupied), np.flatnonzero(self.ends)
        return home, np.maximum(home, np.append(-1, last[:-1]) + 1) if len(home) else home, last

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints in ascending order and their counts."""
        home, first, last = self._runs()
        length = last - first + 1
        if not len(home):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        run = np.repeat(np.arange(len(home)), length)
        at = np.cumsum(length) - length
        flat = self.slots[np.repeat(first - at, length) + np.arange(len(run))]
        # a run of ascending remainders holds counts of one alone
        falls = np.zeros(len(home), bool)
        falls[run[1:][(run[1:] == run[:-1]) & (flat[1:] <= flat[:-1])]] = True
        falls |= (flat[at] == 0) & (length > 1)
        keep = ~falls[run]
        high = home.astype(np.uint64) << np.uint64(self.r) if self.r < 64 else np.zeros(len(home), np.uint64)
        keys, counts = [high[run[keep]] | flat[keep]], [np.ones(int(keep.sum()), np.int64)]
        more = [
            (int(high[k]) | x, c)
            for k in np.flatnonzero(falls).tolist()
            for x, c in decoded(flat[at[k] : at[k] + length[k]].tolist(), self.r)
        ]
        if more:
            keys.append(np.array([x for x, _ in more], np.uint64))
            counts.append(np.array([c for _, c in more], np.int64))
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        return key[order], np.concatenate(counts)[order]

    def count(self, fingerprint: int) -> int:
        """How often a fingerprint was put in: rank among the quotients with a run, then that run alone."""
        quotient, rest = fingerprint >> self.r, fingerprint & ((1 << self.r) - 1)
        if not self.occupied[quotient]:
            return 0
        k = int(np.count_nonzero(self.occupied[:quotient]))
        last = np.flatnonzero(self.ends)
        first = max(quotient, int(last[k - 1]) + 1 if k else 0)
        return dict(decoded(self.slots[first : last[k] + 1].tolist(), self.r)).get(rest, 0)

    def to_bytes(self) -> bytes:
        """Two bits a slot and the remainders in whole bytes."""
        wide = (self.r + 7) // 8
        raw = self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
        head = np.array([self.bits, self.q, len(self.slots)], "<i8").tobytes()
        return head + np.packbits(self.occupied).tobytes() + np.packbits(self.ends).tobytes() + raw.tobytes()

    @classmethod
    def from_bytes(cls, body: bytes) -> CountingQuotientFilter:
        bits, q, size = np.frombuffer(body, "<i8", 3).tolist()
        a = 24 + ((1 << q) + 7) // 8
        b = a + (size + 7) // 8
        occupied = np.unpackbits(np.frombuffer(body[24:a], np.uint8), count=1 << q).astype(bool)
        ends = np.unpackbits(np.frombuffer(body[a:b], np.uint8), count=size).astype(bool)
        wide = (bits - q + 7) // 8
        slots = np.zeros((size, 8), np.uint8)
        slots[:, :wide] = np.frombuffer(body, np.uint8, size * wide, b).reshape(size, wide)
        return cls(bits, q, occupied, ends, slots.view("<u8").ravel())


def merged(filters: Iterable[CountingQuotientFilter], bits: int) -> CountingQuotientFilter:
    """One filter with the counts of all; two neighbours merge first, so no more than a few are open at a time."""
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []

    def join(a, b):
        key, n = np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])
        order = np.argsort(key, kind="stable")  # two sorted runs
        key, n = key[order], n[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        return a[0] + 1, key[first], np.add.reduceat(n, first) if len(first) else n

    for f in filters:
        waiting.append((0, *f.items()))
        while len(waiting) > 1 and waiting[-1][0] == waiting[-2][0]:
            b, a = waiting.pop(), waiting.pop()
            waiting.append(join(a, b))
    while len(waiting) > 1:
        b, a = waiting.pop(), waiting.pop()
        waiting.append(join(a, b))
    if not waiting:
        return CountingQuotientFilter.build(np.zeros(0, np.uint64), np.zeros(0, np.int64), bits)
    return CountingQuotientFilter.build(waiting[0][1], waiting[0][2], bits)
