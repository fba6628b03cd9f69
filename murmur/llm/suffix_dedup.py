"""Removes every byte that lies in a 50-byte string found in a document with a smaller id.

Suffixes are compared where they can have an equal, and nowhere else. A 50-byte string has 31 windows of 20
bytes; the one with the smallest hash is its anchor, and equal strings have equal anchors. So:

1. Texts are packed into chunks of some megabytes in files of the shared folder, where later steps read them.
2. Each chunk sends the hashes of its anchors to the bucket of the hash, each hash once. The bucket answers
   which hashes also occur in another document.
3. Each chunk sends the surroundings of these anchors (30 bytes before, 50 from the anchor on), equal
   surroundings once, with the places where they occur. The bucket sorts the suffixes
   that start in them by deep-shallow sorting; where all 50 bytes agree, the smallest id of the group is known to all.
4. Places where that id is smaller than their own go back to the chunk, which cuts the bytes out.

What is sent is at most one hash and one surrounding per chunk, so a passage that a third of all documents
share weighs no more than one entry from each chunk. All steps are one pass over sorted rows of bounded size.

A null text is empty. Texts under 50 bytes stay whole. Rows without a doc_id are left out; rows
with the same doc_id don't remove each other's bytes; each row of the input has a row in the result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import batch, mix, new_folder, partitions, store, texts
from murmur.llm.deep_shallow import equal_groups
from murmur.llm.grouped import groups

LENGTH = 50
ANCHOR = 20
WINDOWS = LENGTH - ANCHOR + 1  # windows of a string, and strings that hold an anchor
AROUND = LENGTH - ANCHOR  # bytes kept before an anchor
SPAN = AROUND + LENGTH
CHUNK_BYTES = 4 << 20
SLICE = 1 << 19
STRINGS_AT_ONCE = 400_000
SLICE_BYTES = 12 << 20  # of surroundings and places that a bucket compares at once
HASH_BITS = 48  # of an anchor; a chance meeting costs a look at the bytes, no more
CHUNKS = "chunk long, path string, offset long, size long"
UNITS = "bucket int, chunk long, body binary"
OUT = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays behind one another, each after its length, compressed."""
    raw = b"".join(len(a.tobytes()).to_bytes(8, "little") + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(body), 0, []
    for kind in kinds:
        size = int.from_bytes(raw[at : at + 8], "little")
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    """Ascending whole numbers as their differences, byte by byte: high bytes are all zero."""
    return np.diff(x.astype(np.uint64), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.copy()


def _climb(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel())


def chunks(docs: DataFrame, folder: str) -> DataFrame:
    """Pack texts into chunks of some megabytes, in one file of the shared folder per task.

    Returns where each chunk is. A task that runs again writes a file of its own and moves it into place.
    """
    schema = pa.schema([("chunk", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("size", pa.int64())])

    def run(batches):
        number, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        fs, inner = pafs.FileSystem.from_uri(folder)
        name, draft = f"chunks-{number:06d}", f"draft-{number:06d}-{attempt}"
        found, ids, raw, total, offset, out = [], [], [], 0, 0, None

        def put():
            nonlocal offset, out
            if out is None:
                fs.create_dir(inner, recursive=True)
                out = fs.open_output_stream(f"{inner}/{draft}")
            sizes = np.array([len(x) for x in raw], np.int64)
            body = _pack(np.array(ids, np.int64), sizes, np.frombuffer(b"".join(raw), np.uint8))
            out.write(body)
            found.append((number << 32 | len(found), f"{folder}/{name}", offset, len(body)))
            offset += len(body)

        for b in batches:
            for doc_id, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if total and total + len(x) > CHUNK_BYTES:
                    put()
                    ids, raw, total = [], [], 0
                ids.append(doc_id)
                raw.append(x.encode("utf-8", "surrogatepass"))
                total += len(raw[-1])
        if ids:
            put()
            out.close()
            fs.move(f"{inner}/{draft}", f"{inner}/{name}")
            yield batch(schema.names, zip(*found, strict=True), schema)

    return texts(docs).where("doc_id IS NOT NULL").mapInArrow(run, CHUNKS)


class Chunk:
    """The texts of a chunk, read from its place."""

    def __init__(self, path: str, offset: int, size: int):
        fs, inner = pafs.FileSystem.from_uri(path)
        with fs.open_input_file(inner) as f:
            self.ids, self.sizes, self.flat = _unpack(f.read_at(size, offset), "i8", "i8", "u1")
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    @functools.cached_property
    def padded(self) -> np.ndarray:
        """The bytes with zeros on either side, so that all anchors have whole surroundings."""
        return np.concatenate([np.zeros(AROUND, np.uint8), self.flat, np.zeros(LENGTH, np.uint8)])

    def owners(self, at: np.ndarray) -> np.ndarray:
        """Index of the text that each byte belongs to."""
        return np.searchsorted(self.ends, at, side="right")

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of all anchors and the hashes of their bytes."""
        n = len(self.flat)
        whole = np.ones(max(0, n - LENGTH + 1), bool)  # strings within one text
        for e in self.ends[:-1].tolist():
            whole[max(0, e - LENGTH + 1) : e] = False
        found = [_anchors(self.flat[i : i + SLICE + LENGTH - 1], whole[i : i + SLICE]) + i for i in range(0, len(whole), SLICE)]
        at = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        out = np.empty(len(at), np.uint64)
        for i in range(0, len(at), 1 << 16):
            some = at[i : i + (1 << 16)]
            raw = np.zeros((len(some), 24), np.uint8)
            raw[:, :ANCHOR] = sliding_window_view(self.flat, ANCHOR)[some]
            w = raw.view(np.uint64).reshape(-1, 3)
            out[i : i + (1 << 16)] = mix(mix(mix(w[:, 0]) + w[:, 1]) + w[:, 2]) >> np.uint64(64 - HASH_BITS)
        return at, out


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return pick(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def _anchors(flat: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places whose window has the smallest hash of some whole string."""
    if not whole.any():
        return np.zeros(0, np.int64)
    base = np.uint32(0x9E3779B1)
    inverse = np.uint32(pow(int(base), -1, 1 << 32))
    up, down = np.full(len(flat), base), np.full(len(flat), inverse)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint32), np.cumprod(down, dtype=np.uint32)
    sums = np.append(np.uint32(0), np.cumsum((flat.astype(np.uint32) + np.uint32(1)) * up, dtype=np.uint32))
    h = (sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(flat) - ANCHOR + 1]
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h |= np.uint32(1)
    least = _slide(h, WINDOWS, np.minimum)
    least = np.where(whole, least, np.uint32(0))
    edge = np.zeros(WINDOWS - 1, np.uint32)
    most = _slide(np.concatenate([edge, least, edge]), WINDOWS, np.maximum)
    return np.flatnonzero(most == h)


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    return (hashes >> np.uint64(HASH_BITS - 32)) * np.uint64(n) >> np.uint64(32)


def _by_bucket(sorted_hashes: np.ndarray, n: int):
    """Bounds of each bucket's share of sorted hashes."""
    b = _buckets(sorted_hashes, n)
    cuts = [0, *(np.flatnonzero(b[1:] != b[:-1]) + 1).tolist(), len(b)]
    return [(int(b[i]), i, j) for i, j in zip(cuts, cuts[1:], strict=False) if j > i]


UNIT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("body", pa.binary())])


def _units(rows: list) -> pa.RecordBatch:
    return batch(UNIT.names, zip(*rows, strict=True), UNIT)


def _hash_units(packed: DataFrame, n: int) -> DataFrame:
    """Step 2, chunk side: sorted hashes, and whether a hash is in several texts of the chunk."""

    def run(batches):
        for b in batches:
            for chunk, *parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                c = Chunk(*parts)
                at, h = c.anchors()
                if not len(at):
                    continue
                ids = c.ids[c.owners(at)]
                order = np.lexsort((ids, h))
                h, ids = h[order], ids[order]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                last = np.append(first[1:], len(h)) - 1
                several = ids[first] != ids[last]
                h = h[first]
                yield _units([(k, chunk, _pack(_steps(h[i:j]), np.packbits(several[i:j]), np.array([j - i]))) for k, i, j in _by_bucket(h, n)])

    return packed.mapInArrow(run, UNITS)


def _shared(units: DataFrame, n: int) -> DataFrame:
    """Step 2, bucket side: for each unit, which of its hashes are in more than one document.

    Different chunks hold different rows, so a hash of two chunks is in two documents (or in rows that
    share an id, which step 3 finds out).
    """

    def run(batches):
        for g in groups(batches, "bucket"):
            chunk, got = g.column("chunk").to_pylist(), []
            for x in g.column("body").to_pylist():
                steps, several, size = _unpack(x, "u1", "u1", "i8")
                got.append((_climb(steps), np.unpackbits(several, count=int(size[0])).astype(bool)))
            h = np.concatenate([x for x, _ in got])
            order = np.argsort(h, kind="stable")
            s = h[order]
            same = s[1:] == s[:-1]
            twice = np.zeros(len(h), bool)
            twice[order] = np.append(same, False) | np.append(False, same)
            at, rows = 0, []
            bucket = g.column("bucket")[0].as_py()
            for c, (x, several) in zip(chunk, got, strict=True):
                mask = twice[at : at + len(x)] | several
                at += len(x)
                if mask.any():
                    rows.append((bucket, c, _pack(np.array([bucket]), np.packbits(mask))))
            if rows:
                yield _units(rows)

    placed = units.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket")
    return placed.mapInArrow(run, UNITS)


def _with_chunks(packed: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """Places of chunks with the answers of all buckets, the place first."""
    a = packed.select("chunk", F.lit(0).alias("kind"), "path", "offset", "size", F.lit(None).cast("binary").alias("body"))
    none = F.lit(None).cast("long")
    b = answers.select(
        "chunk", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("path"), none.alias("offset"), none.alias("size"), "body"
    )
    return a.unionByName(b).repartition(n, "chunk").sortWithinPartitions("chunk", "kind")


def _opened(batches):
    """(chunk, Chunk, bodies of its answers) of each chunk."""
    for g in groups(batches, "chunk"):
        chunk, kind, path, offset, size, body = (c.to_pylist() for c in g.columns)
        yield chunk[0], Chunk(path[0], offset[0], size[0]), body[1:]


def _around(c: Chunk, at: np.ndarray) -> np.ndarray:
    """The bytes around each anchor, zeros beyond the text, and how many there are before and from it."""
    owner = c.owners(at)
    before = np.minimum(at - c.starts[owner], AROUND)
    beyond = np.minimum(c.ends[owner] - at, LENGTH)
    step = np.arange(-AROUND, LENGTH)
    raw = sliding_window_view(c.padded, SPAN)[at]
    raw[(step < -before[:, None]) | (step >= beyond[:, None])] = 0
    return np.hstack([raw, before[:, None].astype(np.uint8), beyond[:, None].astype(np.uint8)])


def _places(joined: DataFrame, n: int) -> DataFrame:
    """Step 3, chunk side: surroundings of shared anchors, once each, and all their places."""
    whole = np.dtype((np.void, SPAN + 2))

    def run(batches):
        for chunk, c, bodies in _opened(batches):
            if not bodies:
                continue
            answers = {int(k[0]): m for k, m in (_unpack(x, "i8", "u1") for x in bodies)}
            at, h = c.anchors()
            u, which = np.unique(h, return_inverse=True)
            shared = np.zeros(len(u), bool)
            spans = {k: (i, j) for k, i, j in _by_bucket(u, n)}
            for k, mask in answers.items():
                i, j = spans[k]
                shared[i:j] = np.unpackbits(mask, count=j - i)
            keep = shared[which]
            at, k = at[keep], _buckets(h[keep], n)
            order = np.argsort(k, kind="stable")  # places stay in order within a bucket
            at, k = at[order], k[order]
            rows = []
            cuts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(k)], strict=True):
                text = np.ascontiguousarray(_around(c, at[i:j])).view(whole).ravel()
                _, first, same = np.unique(text, return_index=True, return_inverse=True)
                # surroundings in the order of their first places, as they compress best
                place = np.argsort(np.argsort(first))
                u8 = text[np.sort(first)].view(np.uint8)
                ahead = (place[same] - np.arange(j - i)).astype(np.int32)
                owner = c.owners(at[i:j])
                docs, docs_at = np.unique(owner, return_index=True)
                body = _pack(u8, ahead, _steps(at[i:j]), docs_at.astype(np.int64), c.ids[docs])
                rows.append((int(k[i]), chunk, body))
            if rows:
                yield _units(rows)

    return joined.mapInArrow(run, UNITS)


def first_ids(text: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Smallest id that has each of the strings around each anchor: a row per surrounding, a column per string.

    ``text`` holds different surroundings, ``least`` the smallest id of each.
    """
    out = np.repeat(least[:, None], WINDOWS, axis=1)
    # only where an anchor has several surroundings can strings of different ones be equal
    key = np.ascontiguousarray(text[:, AROUND : AROUND + ANCHOR]).view(np.dtype((np.void, ANCHOR))).ravel()
    order = np.argsort(key, kind="stable")
    change = np.append(True, key[order][1:] != key[order][:-1])
    first = np.flatnonzero(change)
    size = np.diff(np.append(first, len(order)))
    order = order[np.repeat(size > 1, size)]
    size = size[size > 1]
    ends = np.cumsum(size)
    o = np.arange(WINDOWS)
    i = 0
    while i < len(order):
        # as many anchors as fit into a bounded number of strings, one at least
        k = max(np.searchsorted(ends, i + STRINGS_AT_ONCE // WINDOWS, side="right"), np.searchsorted(ends, i, side="right") + 1)
        some = order[i : ends[k - 1]]
        i = int(ends[k - 1])
        part = text[some]
        valid = (AROUND - o <= part[:, SPAN, None]) & (o + ANCHOR <= part[:, SPAN + 1, None])
        row, col = np.nonzero(valid)
        flat = np.ascontiguousarray(part[:, :SPAN]).ravel()
        at, group = equal_groups(flat, row * SPAN + col, LENGTH)
        if not len(at):
            continue
        by = np.argsort(group, kind="stable")
        at, group = at[by], group[by]
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        low = np.minimum.reduceat(least[some[row[at]]], start)
        out[some[row[at]], col[at]] = np.repeat(low, np.diff(np.append(start, len(at))))
    return out


def _earlier(units: DataFrame, n: int) -> DataFrame:
    """Steps 3 and 4, bucket side: for each chunk, places and the strings there that an earlier document has."""
    whole = np.dtype((np.void, SPAN + 2))
    bit = np.uint32(1) << np.arange(WINDOWS, dtype=np.uint32)

    def run(batches):
        for g in groups(batches, "bucket"):
            bodies = g.column("body")
            held = sum(zstandard.frame_content_size(x.as_buffer()) for x in bodies)
            slices = -(-held // SLICE_BYTES)
            for number in range(slices):
                got = [_sliced(x.as_py(), number, slices) for x in bodies]
                text = np.concatenate([x[0] for x in got]).view(whole).ravel()
                if not len(text):
                    continue
                offsets = np.cumsum([0, *(len(x[0]) for x in got)])
                u, merged = np.unique(text, return_inverse=True)
                del text
                which = [merged[a + x[1]] for a, x in zip(offsets, got, strict=False)]
                least = np.full(len(u), np.iinfo(np.int64).max)
                for k, x in zip(which, got, strict=True):
                    np.minimum.at(least, k, x[3])
                o = np.arange(WINDOWS)
                rows = u.view(np.uint8).reshape(-1, SPAN + 2)
                valid = (AROUND - o <= rows[:, SPAN, None]) & (o + ANCHOR <= rows[:, SPAN + 1, None])
                first = first_ids(rows, least)
                first[~valid] = np.iinfo(np.int64).max
                out = []
                for chunk, k, x in zip(g.column("chunk").to_pylist(), which, got, strict=True):
                    mask = ((first[k] < x[3][:, None]) * bit).sum(axis=1, dtype=np.uint32)
                    if mask.any():
                        out.append((0, chunk, _pack(x[2][mask > 0], mask[mask > 0])))
                if out:
                    yield _units(out)
            pa.default_memory_pool().release_unused()

    placed = units.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket")
    return placed.mapInArrow(run, UNITS)


def _sliced(body: bytes, number: int, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a unit, the surroundings whose anchors fall into one slice of several, and which of them
    stands at each place, the places and their documents. Equal anchors fall into one slice."""
    around, ahead, steps, docs_at, ids = _unpack(body, "u1", "i4", "u1", "i8", "i8")
    rows, at = around.reshape(-1, SPAN + 2), _climb(steps)
    owner = np.repeat(ids, np.diff(np.append(docs_at, len(at))))
    which = ahead + np.arange(len(at))
    if slices > 1:
        raw = np.zeros((len(rows), 24), np.uint8)
        raw[:, :ANCHOR] = rows[:, AROUND : AROUND + ANCHOR]
        w = raw.view(np.uint64)
        # another mixture than the buckets', of which this one has a share
        mine = mix(mix(mix(w[:, 2]) + w[:, 1]) + w[:, 0]) % np.uint64(slices) == number
        here = mine[which]
        which, at, owner = (np.cumsum(mine) - 1)[which[here]], at[here], owner[here]
        rows = rows[mine]
    return rows, which, at.astype(np.uint32), owner


def _whole_letters(flat: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Also the other bytes of a letter (UTF-8) of which one goes."""
    lead = (flat & 0xC0) != 0x80
    lead[:1] = True
    first = np.flatnonzero(lead)
    return np.repeat(np.logical_or.reduceat(gone, first), np.diff(np.append(first, len(flat)))) if len(flat) else gone


def _cut(joined: DataFrame, whole_letters: bool) -> DataFrame:
    """Step 4, chunk side: the spans to remove and the bytes that stay."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())]
    )

    def run(batches):
        for _, c, bodies in _opened(batches):
            n = len(c.flat)
            change = np.zeros(n + 1, np.int32)
            for x in bodies:
                at, mask = _unpack(x, "u4", "u4")
                for o in range(WINDOWS):
                    s = at[(mask >> np.uint32(o)) & np.uint32(1) > 0].astype(np.int64) - AROUND + o
                    np.add.at(change, s, 1)
                    np.add.at(change, s + LENGTH, -1)
            gone = np.cumsum(change[:n]) > 0
            if whole_letters:
                gone = _whole_letters(c.flat, gone)
            # a run ends where its text ends, even if the next text goes on with removed bytes
            edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
            inner = c.starts[(c.sizes > 0) & (c.starts > 0)]
            inner = inner[gone[inner] & gone[inner - 1]]
            start = np.sort(np.append(np.flatnonzero(edge > 0), inner))
            stop = np.sort(np.append(np.flatnonzero(edge < 0), inner))
            owner = c.owners(start)
            bounds = np.searchsorted(owner, np.arange(len(c.ids) + 1))
            for i in range(0, len(c.ids), 256):
                spans, kept = [], []
                some = range(i, min(i + 256, len(c.ids)))
                for d in some:
                    a, b = bounds[d], bounds[d + 1]
                    low, high = int(c.starts[d]), int(c.ends[d])
                    spans.append([{"start": x - low, "stop": y - low} for x, y in zip(start[a:b].tolist(), stop[a:b].tolist(), strict=True)])
                    kept.append(c.flat[low:high][~gone[low:high]].tobytes())
                k = slice(some.start, some.stop)
                yield batch(schema.names, [c.ids[k], c.sizes[k], spans, kept], schema)

    return joined.mapInArrow(run, OUT)


def remove_repeats(docs: DataFrame, whole_letters: bool = False) -> DataFrame:
    """(doc_id, n_bytes, spans removed, kept bytes) of every row with a doc_id.

    With ``whole_letters`` a letter goes whole where a cut would halve it, so what stays of valid UTF-8 is valid.
    """
    n = partitions(texts(docs))
    folder = new_folder(docs.sparkSession, "chunks")
    packed = store(chunks(docs, folder), "places")
    # Places are dealt out in turn: by a hash of few chunks some tasks would have no work.
    shared = _shared(_hash_units(packed.repartition(n), n), n)
    found = _earlier(_places(_with_chunks(packed, shared, n), n), n)
    return _cut(_with_chunks(packed, found, n), whole_letters)
