"""Groups of equal texts, found by counting quotient filters and confirmed on their bytes.

1. Each task packs its documents into a file (``pieces``): ids, SHA-256 of the bytes, and the bytes in small frames. The
   first bits of the hash are the fingerprint; a counting quotient filter per piece and range of fingerprints holds how
   often each occurs.
2. A range's filters from all pieces are merged by their sorted remainders. Each piece learns which of its
   fingerprints have a count above one in all; documents with any other fingerprint are alone and their texts are not read
   again.
3. The texts behind the repeated fingerprints leave their piece once each, with the number of documents
   and the largest id. Spark groups them by their whole bytes, which is the verification: texts that merely share
   a fingerprint part here, and two texts with one SHA-256 end the job with an error.
4. Size and id to keep go back to the pieces by hash, and each piece writes the rows of its documents.

What many documents share is sent once per piece, never once per document.

A null text is empty. Every row has a row in the result. Null ids count as smaller than all others; the id to keep is null only
where a whole group has none. Of rows with the same text and the same largest id exactly one is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import batch, new_folder, partitions, store
from murmur.llm.grouped import groups
from murmur.llm.pieces import PLACE, PieceFile, Source, opened, pack, unpack, with_answers
from murmur.llm.quotient import CountingQuotientFilter, merged

BITS = 64  # of a fingerprint
ROWS_IN_PIECE = 500_000
FRAME_BYTES = 1 << 20
TEXT_AT_ONCE = 16 << 20  # bytes of repeated texts a task compares before it sends them on
ROWS_OUT = 5_000
DIGEST = 32
PIECES = f"{PLACE}, filters array<struct<bucket:int,body:binary>>"
REPEATED = "piece long, digest binary, body binary, rows long, last_id long"


def _fingerprints(digests: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits of each hash (a row of bytes each)."""
    return digests[:, :8].copy().view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - bits)


def _pieces(docs: DataFrame, folder: str, bits: int, bucket_bits: int) -> DataFrame:
    """Step 1: documents in files; where each piece is, and its filters by range of fingerprints."""
    schema = pa.schema(
        [("piece", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("size", pa.int64()),
         ("filters", pa.list_(pa.struct([("bucket", pa.int32()), ("body", pa.binary())])))]
    )

    def run(batches):
        out = PieceFile(folder, "texts")
        ids, digests, sizes, frames, held, held_bytes = [], [], [], [], [], 0

        def frame():
            nonlocal held, held_bytes
            body = pack(np.frombuffer(b"".join(held), np.uint8))
            _, offset, size = out.write(body)
            frames.append((offset, size, len(held)))
            held, held_bytes = [], 0

        def piece():
            if held:
                frame()
            d = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST)
            null = np.array([x is None for x in ids])
            body = pack(np.array([x or 0 for x in ids], np.int64), null, d, np.array(sizes, np.int64), np.array(frames, np.int64))
            fp = np.sort(_fingerprints(d, bits))
            part = bits - bucket_bits  # bits within a range
            bucket = (fp >> np.uint64(part)).astype(np.int64) if bucket_bits else np.zeros(len(fp), np.int64)
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(fp)]
            inner = fp & np.uint64((1 << part) - 1)
            filters = [
                {"bucket": int(bucket[i]), "body": CountingQuotientFilter.of(inner[i:j], part).to_bytes()}
                for i, j in zip(cuts, cuts[1:], strict=False)
            ]
            return batch(schema.names, [[x] for x in (out.next_piece(), *out.write(body), filters)], schema)

        for b in batches:
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                digests.append(hashlib.sha256(body).digest())
                sizes.append(len(body))
                held.append(body)
                held_bytes += len(body)
                if held_bytes >= FRAME_BYTES:
                    frame()
                if len(ids) >= ROWS_IN_PIECE:
                    yield piece()
                    ids, digests, sizes, frames = [], [], [], []
        if ids:
            yield piece()
        out.close()

    return docs.mapInArrow(run, PIECES)


def _repeated_fingerprints(pieces: DataFrame, bits: int, bucket_bits: int) -> DataFrame:
    """Step 2: (piece, bucket, body) with a bit for each fingerprint of the piece in that range, in their order."""
    schema = pa.schema([("piece", pa.int64()), ("bucket", pa.int32()), ("body", pa.binary())])

    def run(batches):
        for g in groups(batches, "bucket"):
            bodies = g.column("body")
            key, count = merged((CountingQuotientFilter.from_bytes(x.as_py()) for x in bodies), bits - bucket_bits).items()
            twice = key[count > 1]
            if not len(twice):
                continue
            rows = []
            for piece, x in zip(g.column("piece").to_pylist(), bodies, strict=True):
                own, _ = CountingQuotientFilter.from_bytes(x.as_py()).items()
                at = np.searchsorted(twice, own)
                mask = twice[at.clip(max=len(twice) - 1)] == own
                if mask.any():
                    rows.append((piece, g.column("bucket")[0].as_py(), pack(np.packbits(mask))))
            if rows:
                yield batch(schema.names, zip(*rows, strict=True), schema)

    units = pieces.select("piece", F.explode("filters").alias("f")).select("f.bucket", "piece", "f.body")
    # one range per task; a hash of few ranges would leave some tasks without work
    placed = units.repartitionById(1 << bucket_bits, F.col("bucket")).sortWithinPartitions("bucket", "piece")
    return placed.mapInArrow(run, "piece long, bucket int, body binary")


class _Piece:
    """The head of a piece; texts are read when asked for."""

    def __init__(self, source: Source, offset: int, size: int):
        self.source = source
        ids, null, digests, self.sizes, frames = unpack(source.read(offset, size), "i8", "?", "u1", "i8", "i8")
        self.ids = [None if n else i for i, n in zip(ids.tolist(), null.tolist(), strict=True)]
        self.digests = digests.reshape(-1, DIGEST)
        self.frames = frames.reshape(-1, 3)

    def texts(self, wanted: np.ndarray):
        """(row, bytes) of the wanted rows, one frame at a time; other frames stay compressed."""
        start = 0
        for offset, size, rows in self.frames.tolist():
            some = np.flatnonzero(wanted[start : start + rows]).tolist()
            if some:
                (flat,) = unpack(self.source.read(offset, size), "u1")
                ends = np.cumsum(self.sizes[start : start + rows]).tolist()
                raw = flat.tobytes()
                for i in some:
                    yield start + i, raw[ends[i - 1] if i else 0 : ends[i]]
            start += rows


def _repeated_texts(joined: DataFrame, bits: int, bucket_bits: int) -> DataFrame:
    """Step 3, piece side: texts whose fingerprint is repeated, equal ones once, with rows and largest id."""
    schema = pa.schema([("piece", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()), ("rows", pa.int64()), ("last_id", pa.int64())])

    def run(batches):
        for (number, path, offset, size), answers in opened(batches):
            if not answers.num_rows:
                continue
            with Source(path) as source:
                piece = _Piece(source, offset, size)
                fp = _fingerprints(piece.digests, bits)
                own, which = np.unique(fp, return_inverse=True)
                bucket = own >> np.uint64(bits - bucket_bits) if bucket_bits else np.zeros(len(own), np.uint64)
                twice = np.zeros(len(own), bool)
                for k, body in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist(), strict=True):
                    i, j = np.searchsorted(bucket, np.array([k, k + 1], np.uint64)).tolist()
                    twice[i:j] = np.unpackbits(unpack(body, "u1")[0], count=j - i)
                found: dict[bytes, list] = {}
                total = 0
                for row, body in piece.texts(twice[which]):
                    doc_id = piece.ids[row]
                    known = found.get(body)
                    if known is None:
                        found[body] = [piece.digests[row].tobytes(), 1, doc_id]
                        total += len(body)
                    else:
                        known[1] += 1
                        if doc_id is not None and (known[2] is None or doc_id > known[2]):
                            known[2] = doc_id
                    if total > TEXT_AT_ONCE:
                        yield from _rows(number, found, schema)
                        found, total = {}, 0
                yield from _rows(number, found, schema)

    return joined.mapInArrow(run, REPEATED)


def _rows(number: int, found: dict[bytes, list], schema: pa.Schema):
    items = list(found.items())
    for i in range(0, len(items), 256):
        some = items[i : i + 256]
        columns = [[number] * len(some), [v[0] for _, v in some], [k for k, _ in some], [v[1] for _, v in some], [v[2] for _, v in some]]
        yield batch(schema.names, columns, schema)


def _verified(repeated: DataFrame) -> DataFrame:
    """(digest, group_size, keep_id, home): texts grouped by all their bytes; ``home`` is a piece that has keep_id.

    Equal texts of a task are reduced before the shuffle.
    """
    last = F.coalesce("last_id", F.lit(-(1 << 63)))
    same = repeated.groupBy("digest", "body").agg(
        F.sum("rows").alias("group_size"), F.max("last_id").alias("keep_id"), F.max_by("piece", last).alias("home")
    )
    one = same.drop("body").groupBy("digest").agg(
        F.count("*").alias("bodies"), F.max("group_size").alias("group_size"), F.max("keep_id").alias("keep_id"), F.max("home").alias("home")
    )
    clash = F.raise_error(F.lit("two texts have one SHA-256")).cast("long")
    return one.select("digest", F.when(F.col("bodies") > 1, clash).otherwise(F.col("group_size")).alias("group_size"), "keep_id", "home")


OUT = "doc_id long, keep_id long, group_size long, kept boolean, digest binary"


def _judged(joined: DataFrame) -> DataFrame:
    """Step 4: a row for every document of a piece."""
    schema = pa.schema([("doc_id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept", pa.bool_()), ("digest", pa.binary())])

    def run(batches):
        for (number, path, offset, size), answers in opened(batches):
            with Source(path) as source:
                piece = _Piece(source, offset, size)
            columns = (answers.column(c).to_pylist() for c in ("digest", "keep_id", "group_size", "home"))
            known = {d: (keep, n, home == number) for d, keep, n, home in zip(*columns, strict=True)}
            raw, taken = piece.digests.tobytes(), set()
            for start in range(0, len(piece.ids), ROWS_OUT):
                rows = []
                for i in range(start, min(start + ROWS_OUT, len(piece.ids))):
                    doc_id, digest = piece.ids[i], raw[i * DIGEST : (i + 1) * DIGEST]
                    if digest not in known:
                        rows.append((doc_id, doc_id, 1, True, digest))
                        continue
                    keep, n, home = known[digest]
                    kept = home and doc_id == keep and digest not in taken
                    if kept:
                        taken.add(digest)
                    rows.append((doc_id, keep, n, kept, digest))
                yield batch(schema.names, zip(*rows, strict=True), schema)

    return joined.mapInArrow(run, OUT)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    bits: int = BITS,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row; the row with the largest id of equal texts stays.

    ``normalise`` is applied to a text before it is compared and hashed. Fewer ``bits`` make fingerprints meet more often,
    which costs time and changes no result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.cast("binary").alias("body"))
    n = partitions(docs)
    bucket_bits = min((n - 1).bit_length(), bits - 2)
    pieces = store(_pieces(given, new_folder(docs.sparkSession, "texts"), bits, bucket_bits), "pieces")
    answers = _repeated_fingerprints(pieces, bits, bucket_bits)
    repeated = store(_repeated_texts(with_answers(pieces, answers, n), bits, bucket_bits), "repeated")
    held = repeated.select("piece", "digest").distinct().join(_verified(repeated), "digest")
    return _judged(with_answers(pieces, held, n))
