"""Benchmark decontamination by templates.

A text becomes a row of tokens in lower case in which numbers, units after a number, and names (capitalised
words, but at the start of a sentence) are typed slots; several names in a row are one. Windows of
eight tokens with slots instead of values are joined by their hash, so that a question with
other numbers or names still meets its original. Windows on one diagonal (same distance between
the two positions) belong together. On it a value of the item stands for the value of the document that most of its
places have (of equally many the same one, then the first); places with another value don't count. Several values
may have become one. Windows with fewer than 4 words that are no slots are not used so.

Besides, windows of eight words as they stand, in lower case and without slots, are joined by their hash, whatever they
hold and wherever they are. Places are counted in words, a name of two words has two. A document holds an item if the places
that count are at least half of its words.

Items of 4 to 7 tokens are one window of their own length; shorter ones can't be told from
ordinary text and are never found.

Null and empty texts hold nothing, nor do null items. Rows without a doc_id are left out. Rows with the
same doc_id are judged together. Equal items are one, the smallest id stands for them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import batch, mix, runs, texts

WINDOW = 8
LEAST = 4
SHARE = 0.5
UNITS_AT_ONCE = 1 << 19
FILTER_ROWS = 4_000_000  # window hashes of a benchmark that tasks hold to drop others early; beyond it the join does it
NUMBER, UNIT, NAME = 1, 2, 3
VERBATIM = 1 << 32  # keeps the hashes of windows as they stand apart from those of templates

# Units of measure, as they are written after a number.
UNIT_WORDS = (
    "mm cm m km in ft yd mi mile miles meter meters metre metres inch inches foot feet yard yards g kg mg lb lbs oz ton tons gram "
    "grams pound pounds l ml liter liters litre litres gallon gallons s sec ms min mins h hr hrs hour hours minute minutes second "
    "seconds day days week weeks month months year years percent cent cents dollar dollars euro euros usd eur gbp degree degrees "
    "mph kmh kph hz khz mhz ghz kb mb gb tb w kw kwh v a j kj cal kcal"
).split()
SIGNS = "%€$£°¥"


def _tables():
    kind, lower = np.zeros(65536, np.uint8), np.arange(65536, dtype=np.uint16)
    upper, stop = np.zeros(65536, bool), np.zeros(65536, bool)
    for i in range(65536):
        c = chr(i)
        if 0xD800 <= i < 0xE000 or c.isalpha():
            kind[i] = 1
        elif c.isdigit():
            kind[i] = 2
        if c.isupper() and len(c.lower()) == 1 and ord(c.lower()) < 65536:
            lower[i], upper[i] = ord(c.lower()), True
    for i in range(0x300, 0x370):
        kind[i] = 1  # accents belong to their letter
    for c in SIGNS:
        kind[ord(c)] = 3
    for c in ".!?\n\r:;|\"“”«»()[]{}":
        stop[ord(c)] = True
    return kind, lower, upper, stop


KIND, LOWER, UPPER, STOP = _tables()
BASE = np.uint64(0x9E3779B97F4A7C15)


def _hash_runs(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(len(low), BASE), np.full(len(low), inverse)
    up[:1] = down[:1] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up)
    before = np.where(start > 0, sums[start - 1], np.uint64(0))
    return mix((sums[end - 1] - before) * down[start])


def _word_hash(word: str) -> int:
    u = np.frombuffer(word.encode("utf-16-le"), np.uint16)
    return int(_hash_runs(u, np.array([0]), np.array([len(u)]))[0])


UNIT_HASHES = np.sort(np.array([_word_hash(w) for w in UNIT_WORDS], np.uint64))
SLOT_HASHES = mix(np.arange(1, 5, dtype=np.uint64))


def tokens(items: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, slot type or 0, hash as in the template, hash of the value) of the tokens of all texts."""
    return both(items)[0]


def both(items: list[str]):
    """``tokens``; (owner, hash) of the single words they are made of; the first word of each token, and the end."""
    raw = [x.encode("utf-16-le", "surrogatepass") for x in items]
    u = np.frombuffer(b"\n\0".join(raw) + b"\n\0", np.uint16)
    kind, low = KIND[u], LOWER[u]
    # a point or comma between digits is part of the number
    inner = ((u[1:-1] == 46) | (u[1:-1] == 44)) & (kind[:-2] == 2) & (kind[2:] == 2) if len(u) > 2 else np.zeros(0, bool)
    kind[1:-1][inner] = 2
    change = np.append(True, kind[1:] != kind[:-1]) | (kind == 3)
    start = np.flatnonzero(change & (kind > 0))
    breaks = np.append(np.flatnonzero(change), len(u))
    end = breaks[np.searchsorted(breaks, start, side="right")]
    k, value = kind[start], _hash_runs(low, start, end)
    ends = np.cumsum([len(x) // 2 + 1 for x in raw])
    owner = np.searchsorted(ends, start, side="right")
    stops = np.cumsum(STOP[u])

    slot = np.where(k == 2, NUMBER, 0)
    near = np.append(False, (start[1:] - end[:-1] <= 1) & (owner[1:] == owner[:-1]))
    after = near & np.append(False, k[:-1] == 2)
    before = np.append(near[1:] & (k[1:] == 2), False) if len(k) else near
    at = np.searchsorted(UNIT_HASHES, value)
    at[at == len(UNIT_HASHES)] = 0
    slot[((k == 1) & after & (UNIT_HASHES[at] == value)) | ((k == 3) & (after | before))] = UNIT
    # a name begins with a capital, goes on with a small letter, and doesn't begin its sentence
    first = np.append(True, (stops[start[1:]] > stops[end[:-1] - 1]) | (owner[1:] != owner[:-1])) if len(start) else np.zeros(0, bool)
    second = np.minimum(start + 1, len(u) - 1)
    slot[(k == 1) & UPPER[u[start]] & (end - start > 1) & ~UPPER[u[second]] & ~first & (slot == 0)] = NAME
    keep = (k != 3) | (slot == UNIT)
    # names in a row are one, with the value of all of them
    again = (slot == NAME) & np.append(False, slot[:-1] == NAME) & near
    lead = np.flatnonzero(~again)
    words = owner[keep], value[keep]
    first_word = np.append((np.cumsum(keep) - 1)[keep & ~again], len(words[0]))
    if len(lead):
        power = np.where(again, mix(value + np.uint64(1)), value)
        value = np.add.reduceat(power, lead) if again.any() else value
        owner, slot, keep = owner[lead], slot[lead], keep[lead]
    owner, slot, value = owner[keep], slot[keep], value[keep]
    return (owner, slot, np.where(slot > 0, SLOT_HASHES[slot], value), value), words, first_word


def _hashes(seq, width: int, seed: int) -> np.ndarray:
    n = len(seq) - width + 1
    h = np.full(n, seed, np.uint64)
    for i in range(width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + seq[i : i + n]
    return h


def _windows(owner, slot, template, width: int):
    """First token and hash of the windows of one width that hold a slot and words enough."""
    n = len(owner) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = np.cumsum(np.append(0, slot == 0))
    words = words[width:] - words[:-width]
    at = np.flatnonzero((owner[:n] == owner[width - 1 :]) & (words >= min(LEAST, width)) & (words < width))
    return at, mix(_hashes(template, width, width)[at])


def _verbatim(owner, value, width: int):
    """First word and hash of all windows of one width as they stand, in lower case."""
    n = len(owner) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(owner[:n] == owner[width - 1 :])
    return at, mix(_hashes(value, width, width + VERBATIM)[at])


def _schema(*extra) -> pa.Schema:
    return pa.schema([("id", pa.int64()), *extra, ("at", pa.int64()), ("key", pa.int64()), ("width", pa.int32()), ("found", pa.list_(pa.int64()))])


FOUND = "at long, key long, width int, found array<long>"


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, size, words, at, key, width, found): windows of benchmark items with the values in their slots, 0 elsewhere.

    ``words`` are the places of the window's tokens among the item's words, and the end; ``found`` is null
    for windows as they stand.
    """
    schema = _schema(("size", pa.int32()), ("words", pa.list_(pa.int64())))

    def run(batches):
        for b in batches:
            for doc_id, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (owner, slot, template, value), words, first_word = both([x])
                size = len(words[0])
                if size < LEAST:
                    continue
                width = min(window, size)
                at, h = _verbatim(*words, width)
                n = len(at)
                places = [[i, i + width] for i in at.tolist()]
                yield batch(schema.names, [[doc_id] * n, [size] * n, places, at, h.view(np.int64), [width] * n, [None] * n], schema)
                width = min(window, len(owner))
                if width < LEAST:
                    continue
                at, h = _windows(owner, slot, template, width)
                n = len(at)
                values = np.where(slot > 0, value, np.uint64(0)).view(np.int64)
                found = [values[i : i + width].tolist() for i in at.tolist()]
                places = [first_word[i : i + width + 1].tolist() for i in at.tolist()]
                yield batch(schema.names, [[doc_id] * n, [size] * n, places, at, h.view(np.int64), [width] * n, found], schema)

    once = items.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")
    return once.mapInArrow(run, f"id long, size int, words array<long>, {FOUND}")


def document_windows(docs: DataFrame, widths: list[int], wanted: np.ndarray | None) -> DataFrame:
    """(id, at, key, width, found) of documents; with ``wanted`` only windows whose hash it holds.

    Windows as they stand have no ``found``; of equal ones in a run of texts with one id a row is enough.
    """
    schema = _schema()
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(np.sort(wanted))

    def run(batches):
        keys = None if shared is None else shared.value.view(np.uint64)
        keys = None if keys is None else np.sort(keys)

        def held(at, h):
            if keys is None or not len(at):
                return at, h
            k = np.searchsorted(keys, h)
            k[k == len(keys)] = 0
            hit = keys[k] == h
            return at[hit], h[hit]

        for b in batches:
            if keys is not None and not len(keys):
                continue
            ids, items = np.asarray(b.column(0).to_pylist(), np.int64), b.column(1).to_pylist()
            for i, j in runs(items, UNITS_AT_ONCE):
                (owner, slot, template, value), words, _ = both(items[i:j])
                first = np.searchsorted(owner, np.arange(j - i))
                values = np.where(slot > 0, value, np.uint64(0)).view(np.int64)
                for width in widths:
                    at, h = held(*_verbatim(*words, width))
                    if len(at):
                        who = ids[i:j][words[0][at]]
                        order = np.lexsort((h, who))
                        who, h = who[order], h[order]
                        new = np.append(True, (who[1:] != who[:-1]) | (h[1:] != h[:-1]))
                        n = int(new.sum())
                        yield batch(schema.names, [who[new], [0] * n, h[new].view(np.int64), [width] * n, [None] * n], schema)
                    at, h = held(*_windows(owner, slot, template, width))
                    if len(at):
                        found = [values[x : x + width].tolist() for x in at.tolist()]
                        who = owner[at]
                        yield batch(
                            schema.names,
                            [ids[i:j][who], at - first[who], h.view(np.int64), [width] * len(at), found],
                            schema,
                        )

    return docs.mapInArrow(run, f"id long, {FOUND}")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, share, verbatim): items that documents hold, and whether all places that count stand word for word."""
    items = texts(benchmark, "item_id").where("doc_id IS NOT NULL AND text <> ''")
    index = item_windows(items, window).persist()
    try:
        widths = sorted(r["width"] for r in index.select("width").distinct().collect())
        keys = index.select("key").distinct()
        small = keys.limit(FILTER_ROWS + 1).count() <= FILTER_ROWS
        wanted = np.array([r["key"] for r in keys.collect()], np.int64) if small else None
    finally:
        index.unpersist()
    given = texts(docs).where("doc_id IS NOT NULL AND text <> ''")
    windows = document_windows(given, widths, wanted)
    item = index.select(
        F.col("id").alias("item_id"), "size", "words", "width", "key", F.col("at").alias("item_at"), F.col("found").alias("item_found")
    )
    met = windows.withColumnRenamed("id", "doc_id").join(item, ["key", "width"])
    # a row per token of the windows: all words of one that stands as it is are one token without a value
    zero = F.array(F.lit(0).cast("long"))
    same = F.col("item_found").isNull()
    pairs = F.arrays_zip(
        F.when(same, zero).otherwise(F.col("found")).alias("found"),
        F.when(same, zero).otherwise(F.col("item_found")).alias("item_found"),
        F.slice("words", 1, F.size("words") - 1).alias("first"),
        F.slice("words", 2, F.size("words") - 1).alias("end"),
    )
    line = ["doc_id", "item_id", "diagonal"]
    diagonal = F.when(~same, F.col("at") - F.col("item_at")).alias("diagonal")
    each = met.select("doc_id", "item_id", diagonal, "size", F.explode(pairs).alias("pair")).select(*line, "size", "pair.*").distinct()
    # on a diagonal a value of the item stands for the value that most of its places have; the others don't count
    slots = each.where("diagonal IS NOT NULL AND item_found <> 0")
    sort = Window.partitionBy(*line, "item_found", "found")
    slots = slots.withColumn("weight", F.struct(F.count("*").over(sort), F.col("found") == F.col("item_found"), -F.min("first").over(sort)))
    slots = slots.withColumn("most", F.max("weight").over(Window.partitionBy(*line, "item_found"))).where("weight = most")
    counted = each.where("diagonal IS NULL OR item_found = 0").unionByName(slots.select(*each.columns))
    places = counted.select(
        "doc_id", "item_id", "size", F.col("diagonal").isNull().alias("same"), F.explode(F.sequence("first", F.col("end") - 1)).alias("place")
    )
    # places of an item that several windows cover count once
    covered = places.groupBy("doc_id", "item_id", "place").agg(F.max("size").alias("size"), F.max("same").alias("same"))
    total = covered.groupBy("doc_id", "item_id").agg(
        (F.count("*") / F.max("size")).alias("share"), F.min("same").alias("verbatim")
    )
    return total.where(F.col("share") >= share)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(doc_id, contaminated, items, share, verbatim): a row per row of ``docs`` with a doc_id."""
    held = matches(docs, benchmark, window, share).groupBy("doc_id").agg(
        F.sort_array(F.collect_list("item_id")).alias("items"), F.max("share").alias("share"), F.max("verbatim").alias("verbatim")
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    out = ids.join(held, "doc_id", "left")
    return out.select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
        F.coalesce("verbatim", F.lit(False)).alias("verbatim"),
    )
