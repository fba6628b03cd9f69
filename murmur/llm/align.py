"""Aligns the tokens of two tokenizers over the same bytes, by pointer jumping, and counts aligned ids over the corpus.

Tokens of both overlap where their byte ranges do; a group is a connected component of overlaps, and ends
where both have a token that ends. Every token points to its farthest-right overlapping token (of two that end
together, that of the second tokenizer, which points to itself). Successor doubling, a gather of an array by itself for
all tokens of a run of texts at once, takes every token to the last one of its component, which names the group.

A link is a pair of tokens that end together. How many links a pair of ids has in all texts decides which
links are best for the second tokenizer's id:

1. Each task aligns its texts, packs what the last step needs into pieces of a file (``pieces``) and passes on the
   different pairs of ids of each piece with their number.
2. Spark adds the numbers up and finds the highest of each id. An id or pair that is in every text comes once per piece.
3. The sums go back to the pieces that asked for them, which finish their documents.

Texts that are null, empty, no UTF-8 or that a tokenizer doesn't give back byte by byte have no tokens: zeros, and
an empty hash. Every row has a row in the result, whatever its id. A text is aligned whole, so a task needs
memory for the tokens of its longest text.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.bpe import WORDS, vocabulary
from murmur.llm.common import batch, new_folder, partitions, store
from murmur.llm.pieces import PieceFile, Source, opened, pack, unpack, with_answers

BYTES_AT_ONCE = 2 << 20
PIECE_BYTES = 16 << 20
ROWS_IN_PIECE = 200_000


class First:
    """A byte-level BPE file; special tokens in a text are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        v = vocabulary(path)
        self.bytes = [v.bytes[i] for i in range(len(v.bytes))]
        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.slow.encode_special_tokens = True
        self.fast = None
        if (np.diff(v.made) > 0).all():  # ids in the order of the merges are ranks
            import tiktoken

            special = set(v.added.values())
            ranks = {x: i for i, x in enumerate(self.bytes) if i not in special}
            self.fast = tiktoken.Encoding("given", pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode_ordinary(text)
            except ValueError:  # its pattern gives up on very long runs
                pass
        return self.slow.encode(text, add_special_tokens=False).ids


class Second:
    """A sentencepiece model, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [
            bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("\u2581", " ").encode()
            for i in range(n)
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@functools.lru_cache(maxsize=2)
def tokenizers(first: str, second: str) -> tuple:
    """Both, and tables of their tokens' sizes and written ids; once per worker process."""
    a, b = First(first), Second(second)
    sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (a, b)]
    return a, b, *sizes, _written(max(map(len, sizes)))


def _written(n: int) -> np.ndarray:
    """Decimal digits of the numbers below ``n``, zero bytes before them, and one byte for what follows."""
    width = len(str(max(1, n - 1)))
    text = "".join(str(i).rjust(width, "\0") + "\0" for i in range(n)).encode()
    return np.frombuffer(text, np.uint8).reshape(n, width + 1)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token of the first and then of the second tokenizer, the last token of its component.

    Given are the ends of the tokens in bytes, both reaching the same end; tokens of the first are numbered first.
    """
    na = len(ends_a)
    # the farthest token that overlaps: the first of the others that ends here or later
    right_b = np.searchsorted(ends_b, ends_a)
    right_a = np.searchsorted(ends_a, ends_b)
    own = np.arange(na, na + len(ends_b))
    after = np.concatenate([right_b + na, np.where(ends_a[right_a] == ends_b, own, right_a)]).astype(np.int32)
    while True:
        jumped = after[after]
        if np.array_equal(jumped, after):
            return after
        after = jumped


class Run:
    """The alignment of a run of texts, given as ids of both tokenizers and the number of tokens of each text."""

    def __init__(self, a, b, many_a, many_b, size_a, size_b):
        self.a, self.b = a, b
        # ends count through all texts, and the texts' ends are among both: no group crosses them
        ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        last = terminals(ends_a, ends_b)
        na = len(a)
        closing, group = np.unique(last, return_inverse=True)  # terminals are tokens of the second, in order
        self.group_a, self.group_b = group[:na], group[na:]
        at_b = closing - na
        self.pair_a, self.pair_b = a[np.searchsorted(ends_a, ends_b[at_b])], b[at_b]
        # groups of each text, by the second tokenizer's tokens up to its end
        stop = np.cumsum(many_b)
        self.ends = np.searchsorted(at_b, stop)
        self.many_a, self.many_b = many_a, many_b

    def written(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All groups as text, and where the text of each document ends."""
        na, nb, ng = len(self.a), len(self.b), len(self.pair_a)
        in_a, in_b = np.cumsum(np.bincount(self.group_a, minlength=ng)), np.cumsum(np.bincount(self.group_b, minlength=ng))
        # groups in order, in each the first tokenizer's tokens before the second's
        place_a = np.arange(na) + np.append(0, in_b)[self.group_a]
        place_b = np.arange(nb) + in_a[self.group_b]
        out = np.empty((na + nb, table.shape[1]), np.uint8)
        out[place_a], out[place_b] = table[self.a], table[self.b]
        out[:, -1] = ord(",")
        out[in_a + np.append(0, in_b[:-1]) - 1, -1] = ord("|")
        out[in_a + in_b - 1, -1] = ord(";")
        closes = (in_a + in_b)[self.ends[self.many_b > 0] - 1]
        out[closes - 1, -1] = 0
        shown = out != 0
        letters = np.cumsum(shown.sum(axis=1))
        tokens = np.cumsum(self.many_a + self.many_b)
        return out[shown], np.append(0, letters)[tokens]


def _ids(items: list[bytes], first: First, second: Second) -> tuple[list, list]:
    """Ids of each text by both; none where one doesn't give the bytes back."""
    a, b = [], []
    for raw in items:
        x, y = [], []
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = ""
        if text:
            want = b" " + raw
            x, y = first.encode(" " + text), second.encode(text)
            if b"".join(map(first.bytes.__getitem__, x)) != want or b"".join(map(second.bytes.__getitem__, y)) != want:
                x, y = [], []
        a.append(x)
        b.append(y)
    return a, b


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    many = np.array([len(x) for x in lists], np.int64)
    out = np.empty(int(many.sum()), np.int32)
    at = 0
    for x in lists:
        out[at : at + len(x)] = x
        at += len(x)
    return out, many


def aligned(items: list[bytes], first: str, second: str) -> Iterator[tuple[Run, list[str]]]:
    """The alignment of the texts and the hash of each text's groups as they are written."""
    one, two, size_a, size_b, table = tokenizers(first, second)
    a, b = _ids(items, one, two)
    run = Run(*(x for pair in zip(_flat(a), _flat(b), strict=True) for x in pair), size_a, size_b)
    text, ends = run.written(table)
    raw, start, hashes = text.tobytes(), 0, []
    for n, end in zip(run.many_a.tolist(), ends.tolist(), strict=True):
        hashes.append(hashlib.sha256(raw[start:end]).hexdigest() if n else "")
        start = end
    return run, hashes


def _runs(items: list[bytes]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, x in enumerate(items):
        if total and total + len(x) > BYTES_AT_ONCE:
            yield start, i
            start, total = i, 0
        total += len(x)
    if start < len(items):
        yield start, len(items)


ALIGNED = "piece long, path string, offset long, size long, a int, b int, links long"


def _aligned(docs: DataFrame, folder: str, first: str, second: str) -> DataFrame:
    """Step 1: places of pieces (``path`` given) and the number of links of each pair of ids in a piece (``a`` given)."""
    schema = pa.schema(
        [(c, pa.int64()) if c in ("piece", "offset", "size", "links") else (c, pa.string() if c == "path" else pa.int32())
         for c in ("piece", "path", "offset", "size", "a", "b", "links")]
    )

    def run(batches):
        out = PieceFile(folder, "aligned")
        held, size, rows = [], 0, 0

        def piece():
            parts = [np.concatenate(x) for x in zip(*held, strict=True)]
            pairs, links = np.unique(parts[-1], return_counts=True)
            number = out.next_piece()
            place = out.write(pack(*parts))
            yield batch(schema.names, [[number], *([x] for x in place), [None], [None], [None]], schema)
            for i in range(0, len(pairs), 1 << 16):
                some = pairs[i : i + (1 << 16)]
                none = [None] * len(some)
                columns = [[number] * len(some), none, none, none, (some >> 32).astype(np.int32), (some & 0xFFFFFFFF).astype(np.int32), links[i : i + (1 << 16)]]
                yield batch(schema.names, columns, schema)

        for b in batches:
            ids, items = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in _runs(items):
                done, hashes = aligned(items[i:j], first, second)
                links = np.diff(np.append(0, done.ends))
                held.append((
                    np.array([x or 0 for x in ids[i:j]], np.int64), np.array([x is None for x in ids[i:j]]), done.many_a, done.many_b, links,
                    np.frombuffer("".join(h or "0" * 64 for h in hashes).encode(), np.uint8),
                    done.pair_a.astype(np.int64) << 32 | done.pair_b,
                ))
                size, rows = size + sum(map(len, items[i:j])), rows + j - i
                if size > PIECE_BYTES or rows > ROWS_IN_PIECE:
                    yield from piece()
                    held, size, rows = [], 0, 0
        if held:
            yield from piece()
        out.close()

    return docs.mapInArrow(run, ALIGNED)


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finished(joined: DataFrame) -> DataFrame:
    """Step 3: a row for every document of a piece."""
    names = [x.split()[0] for x in OUT.split(", ")]
    schema = pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in names])

    def run(batches):
        for (_, path, offset, size), answers in opened(batches):
            with Source(path) as source:
                ids, null, many_a, many_b, links, hashes, pairs = unpack(source.read(offset, size), "i8", "?", "i8", "i8", "i8", "u1", "i8")
            a, b, total, best = (answers.column(c).to_numpy() for c in ("a", "b", "total", "best"))
            key = a.astype(np.int64) << 32 | b.astype(np.int64)
            order = np.argsort(key)
            at = order[np.searchsorted(key[order], pairs)] if len(key) else np.zeros(0, np.int64)
            ends = np.cumsum(links)

            def per_text(values):
                sums = np.append(0, np.cumsum(values, dtype=np.int64))
                return sums[ends] - sums[ends - links]

            n_best, count_sum = per_text(best.astype(np.int64)[at]), per_text(total.astype(np.int64)[at])
            text = hashes.tobytes().decode()
            for i in range(0, len(ids), 5000):
                k = slice(i, i + 5000)
                doc_ids = pa.array(ids[k], mask=null[k])
                shown = [text[64 * x : 64 * x + 64] if many_a[x] else "" for x in range(i, min(i + 5000, len(ids)))]
                yield batch(names, [doc_ids, many_a[k], many_b[k], links[k], links[k], n_best[k], count_sum[k], shown], schema)

    return joined.mapInArrow(run, OUT)


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, total, best): links of each pair of ids over all texts, and whether no other pair of ``b`` has more."""
    total = links.groupBy("b", "a").agg(F.sum("links").alias("total"))
    most = F.max("total").over(Window.partitionBy("b"))  # no more rows than the first vocabulary has ids
    return total.select("a", "b", "total", (F.col("total") == most).cast("int").alias("best"))


def alignment(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: its tokens by both tokenizers, groups, links and what the corpus says of them.

    ``first`` is the file of a byte-level BPE, ``second`` that of a sentencepiece model.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("body"))
    stored = store(_aligned(given, new_folder(docs.sparkSession, "aligned"), first, second), "pieces")
    places = stored.where("path IS NOT NULL").select("piece", "path", "offset", "size")
    links = stored.where("a IS NOT NULL").select("piece", "a", "b", "links")
    answers = links.drop("links").join(pair_counts(links), ["a", "b"])
    return _finished(with_answers(places, answers, partitions(given)))
