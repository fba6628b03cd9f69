"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds documents in ascending order of doc_id, one frame per document with its ids as
little-endian unsigned 32-bit integers. After the frames come two skippable frames: the
doc_ids (64-bit integers), and last the seek table of the public seekable format, with
compressed size, size and checksum (low half of XXH64 of the content) of each frame. Any
zstandard decoder reads such a file; a reader that wants some documents reads the
two tables and decompresses these documents' frames alone.

Files are numbered in the order of their documents; a table (the manifest) beside them has for each file its first and
last doc_id and its counts. A task that runs again writes its file anew under a name of its own and moves it into
place, so the folder holds each file once whatever was lost.

Null texts are empty and have the end id alone. Rows without a doc_id can't be found again and are left
out. A doc_id given several times has a frame for each row, in the order of the text.
"""

from __future__ import annotations

import functools
import json
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.llm.bpe import byte_letters
from murmur.llm.common import batch, partitions, runs, texts

END_ID = 2
LEVEL = 3
CHARS_AT_ONCE = 4 << 20
MEMORY_BYTES = 96 << 20  # of remembered pieces and words; all are forgotten beyond that, between two runs of texts
ENTRY_BYTES = 160  # of an entry besides the text and the ids
MARK = "\x01"
# Fixed values of the public zstandard formats.
SKIPPABLE, SEEK_SKIPPABLE, SEEK_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
# Fixed value: how the vocabulary's file splits a text; and the same for plain letters, printable ASCII and the letters
# of Latin-1, which no normal form changes and which have one lower case of one letter.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


class Encoder:
    """The library's tokenizer behind a memory for pieces between spaces and for the words they are made of.

    Spaces and line ends stand in no token of a vocabulary that drops white space, and its rules look at
    nothing beyond them, so the ids of a text are those of its pieces in a row. What the file's normaliser and splitter
    do to plain letters is done here, where they are known ones, and the library's model gets the words; all
    other pieces go through the whole library.
    """

    def __init__(self, path: str, by_piece: bool):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        self.tokenizer, self.by_piece = Tokenizer.from_file(path), by_piece
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        steps = _steps(given.get("normalizer"), "normalizers")
        self.lower = any(x["type"] == "Lowercase" for x in steps)
        splits = _steps(given.get("pre_tokenizer"), "pretokenizers")
        plain = all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} for x in steps)
        known = [x.get("pattern", {}).get("Regex") for x in splits] == [WORDS, None] and splits[1]["type"] == "ByteLevel"
        self.plain = plain and known and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"]
        # a piece in which an added token may begin is the library's business
        begins = "|".join(re.escape(t["content"][:2]) for t in given["added_tokens"]) or "(?!)"
        self.added = re.compile(begins)
        self.is_plain = re.compile(rf"(?!.*(?:{begins}))[!-~{LETTERS}]+").fullmatch
        # the letters that stand for the bytes of a word in the vocabulary
        self.letters = {b: ord(c) for b, c in byte_letters().items()}
        self.known: dict[str, bytes] = {}
        self.held = 0  # bytes of the memory, about
        # a word of its own that parts pieces within one long text, if it has a single id
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def _pieces(self, items: list[str]) -> list[bytes]:
        """As ``_ids`` for pieces without spaces, with one call of the library for many."""
        if self.mark is None:
            return self._ids(items)
        out: list[bytes] = []
        for i in range(0, len(items), 5000):
            some = items[i : i + 5000]
            ids = np.array(self.tokenizer.encode_batch_fast([f" {MARK} ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(some) - 1:  # a piece holds the mark itself
                out += self._ids(some)
                continue
            raw, start = ids.tobytes(), 0
            for stop in (cuts * 4).tolist():
                out.append(raw[start:stop])
                start = stop + 4
            out.append(raw[start:])
        return out

    def _ids(self, items: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(items, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _plain(self, piece: str) -> bytes:
        """Ids of a piece of plain letters, word by word."""
        known, out = self.known, []
        for w in PLAIN_WORDS.findall(piece.lower() if self.lower else piece):
            if w not in known:
                spelled = w if w.isascii() else w.encode().decode("latin-1").translate(self.letters)
                ids = [t.id for t in self.model.tokenize(spelled)]
                self._remember(w, struct.pack(f"<{len(ids)}I", *ids))
            out.append(known[w])
        return b"".join(out)

    def _remember(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.held += len(piece) + len(ids) + ENTRY_BYTES

    def encode(self, items: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self._ids(items)
        if self.held > MEMORY_BYTES:
            self.known, self.held = {}, 0
        known, split = self.known, []
        for x in items:
            if self.lower and x.isascii() and not self.added.search(x):  # else case may matter
                x = x.lower()
            split.append(x.replace("\n", " ").split(" "))
        rest = []
        for p in set().union(*split):
            # a piece is also a word of others, which may have been met just now
            if p in known:
                continue
            if self.plain and self.is_plain(p):
                ids = self._plain(p)
                if p not in known:
                    self._remember(p, ids)
            else:
                rest.append(p)
        for p, ids in zip(rest, self._pieces(rest), strict=True):
            self._remember(p, ids)
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]


def _steps(given: dict | None, name: str) -> list[dict]:
    """The steps of a normaliser or splitter as the file has them."""
    if not given:
        return []
    return given[name] if given["type"] == "Sequence" else [given]


@functools.lru_cache(maxsize=2)
def encoder(path: str, by_piece: bool) -> Encoder:
    """One per worker process."""
    return Encoder(path, by_piece)


def frame_tail(doc_ids: list[int], entries: list[tuple[int, int, int]]) -> bytes:
    """The two skippable frames at the end of a file."""
    ids = np.array(doc_ids, "<i8").tobytes()
    table = np.array(entries, ENTRY).tobytes() + struct.pack("<IBI", len(entries), WITH_CHECKSUMS, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE, len(ids)) + ids + struct.pack("<II", SEEK_SKIPPABLE, len(table)) + table


class Reader:
    """Frames of one file; decompresses what is asked for and nothing else."""

    def __init__(self, path: str):
        fs, inner = pafs.FileSystem.from_uri(path)
        self.path, self.file = path, fs.open_input_file(inner)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        at = size - 9 - n * ENTRY.itemsize
        self.entries = np.frombuffer(self.file.read_at(n * ENTRY.itemsize, at), ENTRY)
        self.doc_ids = np.frombuffer(self.file.read_at(8 * n, at - 8 - 8 * n), "<i8")
        self.offsets = np.cumsum(np.append(0, self.entries["packed"].astype(np.int64)))
        self.starts = np.cumsum(np.append(0, self.entries["size"].astype(np.int64))) // 4
        self.unpack = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        e = self.entries[i]
        raw = self.unpack.decompress(self.file.read_at(int(e["packed"]), int(self.offsets[i])), int(e["size"]))
        if len(raw) != e["size"] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != e["check"]:
            raise ValueError(f"{self.path}: frame {i} is damaged")
        return raw

    def find(self, doc_id: int) -> list[bytes]:
        """Frames of a document; none if the file hasn't got it."""
        a, b = np.searchsorted(self.doc_ids, [doc_id, doc_id + 1])
        return [self.frame(i) for i in range(a, b)]


def write(docs: DataFrame, folder: str, path: str, by_piece: bool = True, end_id: int = END_ID) -> DataFrame:
    """Encode every whole text and write the files; returns the manifest, stored beside them.

    ``path`` is the tokenizer's file, ``by_piece`` says that its vocabulary drops white space.
    """
    given = texts(docs).where("doc_id IS NOT NULL")
    ordered = given.repartitionByRange(partitions(given), "doc_id").sortWithinPartitions("doc_id", "text")
    schema = pa.schema(
        [("file", pa.int32()), ("path", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())]
    )

    def run(batches):
        number, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        fs, inner = pafs.FileSystem.from_uri(folder)
        fs.create_dir(inner, recursive=True)
        name, draft = f"part-{number:06d}.zst", f"draft-{number:06d}-{attempt}"
        doc_ids, entries, out, tokens = [], [], None, 0
        pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        end = np.uint32(end_id).astype("<u4").tobytes()
        for b in batches:
            ids, items = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in runs(items, CHARS_AT_ONCE):
                for doc_id, raw in zip(ids[i:j], encoder(path, by_piece).encode(items[i:j]), strict=True):
                    raw += end
                    frame = pack.compress(raw)
                    out = out or fs.open_output_stream(f"{inner}/{draft}")
                    out.write(frame)
                    doc_ids.append(doc_id)
                    entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
                    tokens += len(raw) // 4
        if out:
            out.write(frame_tail(doc_ids, entries))
            out.close()
            fs.move(f"{inner}/{draft}", f"{inner}/{name}")
            row = [number, f"{folder}/{name}", doc_ids[0], doc_ids[-1], len(doc_ids), tokens]
            yield batch(schema.names, [[x] for x in row], schema)

    columns = "file int, path string, first_id long, last_id long, docs long, tokens long"
    ordered.mapInArrow(run, columns).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(columns).parquet(f"{folder}/manifest")


def open_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of files written before."""
    return spark.read.parquet(f"{folder}/manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids): each document, the number of ids before it in all files, its ids as bytes.

    The running sum is over one small row per file. Files are spread over tasks and read frame by frame.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                r = Reader(path)
                for i in range(0, len(r.doc_ids), 1000):
                    j = min(i + 1000, len(r.doc_ids))
                    frames = [r.frame(k) for k in range(i, j)]
                    yield batch(schema.names, [r.doc_ids[i:j], start + r.starts[i:j], frames], schema)

    spark = manifest.sparkSession
    n = max(1, min(manifest.count(), 100_000))
    # a plain round over the tasks: a hash of paths would leave some without work
    return files.repartition(n).mapInArrow(run, "doc_id long, start long, ids binary") if n else spark.createDataFrame([], "doc_id long, start long, ids binary")


def fetch(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the wanted doc_ids: reads the tables of their files and their frames alone.

    The manifest has one row per file of some 64 MB of text, so it is small enough to broadcast.
    """
    files = F.broadcast(manifest.select("path", "first_id", "last_id"))
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    at = ids.join(files, (F.col("doc_id") >= F.col("first_id")) & (F.col("doc_id") <= F.col("last_id")))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        path, r = None, None
        for b in batches:
            for p, doc_id in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if p != path:
                    path, r = p, Reader(p)
                found = r.find(doc_id)
                yield batch(schema.names, [[doc_id] * len(found), found], schema)

    placed = at.select("path", "doc_id").repartition("path").sortWithinPartitions("path", "doc_id")
    return placed.mapInArrow(run, "doc_id long, ids binary")
