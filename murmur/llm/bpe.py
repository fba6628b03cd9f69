"""Byte-level BPE encoding and decoding with an index of pair occurrences.

The words of a run of texts are collected once. Their bytes stand in one row of linked symbols, and an
index maps each rank of the merge table to all positions of its pair. Ranks are applied in ascending
order, each to all its positions at once; the pairs that a merge makes join the lists of
their own ranks, and positions whose pair is gone are passed over. Words don't touch each other, so the result
is that of merging every word by itself.

A null text is empty and has no ids. Strings of added tokens in a text become their ids, as the
library does. Decoding joins the bytes of the ids and replaces what is no UTF-8; an unknown or null id adds
nothing, null ids decode to an empty text.
"""

from __future__ import annotations

import functools
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import runs, texts

CHARS_AT_ONCE = 4 << 20
WORDS_KEPT = 300_000  # encoded words a worker remembers; it forgets all of them beyond that

# Fixed value: how the vocabulary splits text into words.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


# The same for texts of ASCII alone, which most are.
PLAIN_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


def split_words(text: str) -> list[str]:
    return PLAIN_WORDS.findall(text) if text.isascii() else WORDS.findall(text)


class Vocabulary:
    """Merge table and token bytes of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        model, letters = given["model"], byte_letters()
        ids, back = model["vocab"], {c: b for b, c in letters.items()}
        self.of_byte = np.array([ids[letters[b]] for b in range(256)], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        a = np.array([ids[x] for x, _ in pairs], np.int64)
        b = np.array([ids[y] for _, y in pairs], np.int64)
        self.left, self.right = a, b
        self.made = np.array([ids[x + y] for x, y in pairs], np.int64)
        keys = a << 32 | b
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.added = {t["content"]: t["id"] for t in given["added_tokens"]}
        size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes = [b""] * size
        for token, i in ids.items():
            self.bytes[i] = bytes(back[c] for c in token)
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.split_added = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the two don't merge."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank_of[at], -1)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _apart(p: np.ndarray, follower: np.ndarray) -> np.ndarray:
    """Of positions of a pair of equal symbols, those left when each takes the next one with it."""
    out, taken = [], -1
    for i, q in zip(p.tolist(), follower.tolist(), strict=True):
        if i != taken:
            out.append(i)
            taken = q
    return np.array(out, np.int64)


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row and the number of ids of each word."""
    sizes = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), sizes
    # position n is the end of every word: symbol -1 merges with nothing
    symbol = np.append(v.of_byte[raw], -1)
    ends = np.cumsum(sizes)
    after = np.arange(1, n + 2)
    after[ends[sizes > 0] - 1] = n
    before = np.arange(-1, n)
    before = np.append(before[:n], n)
    before[(ends - sizes)[sizes > 0]] = n

    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def enter(positions: np.ndarray) -> None:
        rank = v.ranks(symbol[positions], symbol[after[positions]])
        known = rank >= 0
        positions, rank = positions[known], rank[known]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        starts = [0, *cuts.tolist(), len(rank)]
        for a, b, r in zip(starts, starts[1:], rank[[0, *cuts]].tolist(), strict=False):
            if r not in index:
                index[r] = []
                heapq.heappush(waiting, r)
            index[r].append(positions[a:b])

    enter(np.arange(n))
    while waiting:
        r = heapq.heappop(waiting)
        lists = index.pop(r)
        p = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
        left, right = v.left[r], v.right[r]
        p = p[(symbol[p] == left) & (symbol[after[p]] == right)]
        if left == right and len(p) > 1:
            p = _apart(p, after[p])
        if not len(p):
            continue
        q = after[p]
        beyond = after[q]
        symbol[p], symbol[q] = v.made[r], -2
        after[p] = beyond
        before[beyond] = p
        front = before[p]
        enter(np.concatenate([front[front < n], p[beyond < n]]))
    alive = symbol[:n] >= 0
    owner = np.repeat(np.arange(len(words)), sizes)
    return symbol[:n][alive], np.bincount(owner[alive], minlength=len(words))


class Encoder:
    """Encodes runs of texts; keeps the ids of the words it has met."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.known: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        """Words of the text; an added token is a part of its own, with its id known."""
        v = self.v
        if v.split_added is None or not v.split_added.search(text):
            return split_words(text)
        out, at = [], 0
        for m in v.split_added.finditer(text):
            # \0 marks the part as a token: no word but one of the text itself starts so
            out += [*split_words(text[at : m.start()]), ("\0", m.group())]
            at = m.end()
        return out + split_words(text[at:])

    def encode(self, items: list[str]) -> list[np.ndarray]:
        """Ids (unsigned 32 bits) of each text."""
        split = [self.parts(x) for x in items]
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        plain = [w for w in new if isinstance(w, str)]
        ids, sizes = merge_words(self.v, [w.encode("utf-8", "surrogatepass") for w in plain])
        raw, at = ids.astype("<u4").tobytes(), 0
        for w, size in zip(plain, (sizes * 4).tolist(), strict=True):
            known[w] = raw[at : at + size]
            at += size
        for w in new:
            if not isinstance(w, str):
                known[w] = np.uint32(self.v.added[w[1]]).astype("<u4").tobytes()
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4") for words in split]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""

    def run(batches):
        for b in batches:
            items, ids = b.column(1).to_pylist(), b.column(0)
            for i, j in runs(items, CHARS_AT_ONCE):
                found = encoder(path).encode(items[i:j])
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate(found).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"]
                )

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])


def text_of(table: list[bytes], ids: list[int]) -> str:
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the text of every row of ids."""

    def run(batches):
        table = vocabulary(path).bytes
        size = len(table)
        for b in batches:
            rows = ([i for i in x if i is not None and 0 <= i < size] if x else [] for x in b.column(1).to_pylist())
            out = pa.array([text_of(table, x) for x in rows], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(DECODED.field(1).type), out], schema=DECODED)

    given = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return given.mapInArrow(run, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): ids of every whole text, and the text decoded from these ids, in one task."""

    def run(batches):
        table = vocabulary(path).bytes
        for b in batches:
            items, ids = b.column(1).to_pylist(), b.column(0)
            for i, j in runs(items, CHARS_AT_ONCE):
                found = encoder(path).encode(items[i:j])
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = pa.array(np.concatenate(found).astype(np.int32))
                back = pa.array([text_of(table, x.tolist()) for x in found], pa.string())
                columns = [ids.slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), flat), back]
                yield pa.RecordBatch.from_arrays(columns, schema=DECODED)

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, text string")
