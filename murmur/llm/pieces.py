"""Rows packed into pieces of bounded size, in files of the shared folder, that later steps read again.

A task writes one file under a name of its own; the rows that it passes on say where each piece is. A task that runs again
writes another file, and only the places of the attempt that succeeded are ever read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.grouped import groups

PLACE = "piece long, path string, offset long, size long"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays behind one another, each after its length in bytes, compressed."""
    raw = b"".join(a.nbytes.to_bytes(8, "little") + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(body), 0, []
    for kind in kinds:
        size = int.from_bytes(raw[at : at + 8], "little")
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


class PieceFile:
    """The file of one task, opened with its first piece."""

    def __init__(self, folder: str, name: str):
        context = TaskContext.get()
        self.number = context.partitionId()
        self.folder, self.name = folder, f"{name}-{self.number:06d}-{context.taskAttemptId()}"
        self.out, self.offset, self.pieces = None, 0, 0

    def write(self, body: bytes) -> tuple[str, int, int]:
        """(path, offset, size) of the bytes."""
        if self.out is None:
            fs, inner = pafs.FileSystem.from_uri(self.folder)
            fs.create_dir(inner, recursive=True)
            self.out = fs.open_output_stream(f"{inner}/{self.name}")
        self.out.write(body)
        self.offset += len(body)
        return f"{self.folder}/{self.name}", self.offset - len(body), len(body)

    def next_piece(self) -> int:
        """A number for a piece that no other task gives."""
        self.pieces += 1
        return self.number << 32 | (self.pieces - 1)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


class Source:
    """A file that pieces are read from."""

    def __init__(self, path: str):
        fs, inner = pafs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(inner)

    def read(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def with_answers(places: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """Each piece's place followed by the answers to it, dealt out by piece.

    ``answers`` has the column piece and any others, which are null in the rows of places.
    """
    a = places.select("piece", F.lit(0).alias("kind"), "path", "offset", "size")
    b = answers.withColumn("kind", F.lit(1))
    return a.unionByName(b, allowMissingColumns=True).repartition(n, "piece").sortWithinPartitions("piece", "kind")


def opened(batches) -> Iterator[tuple[tuple[int, str, int, int], pa.Table]]:
    """((piece, path, offset, size), its answers) of each piece of ``with_answers``."""
    for g in groups(batches, "piece"):
        place = g.slice(0, 1)
        yield tuple(place.column(c)[0].as_py() for c in ("piece", "path", "offset", "size")), g.slice(1)
