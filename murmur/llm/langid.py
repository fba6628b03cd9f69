"""Language by interpolated Kneser-Ney models over characters.

Counts of 4-grams, per language and over all training texts, are gathered on Spark; each task
sends one row for each gram it has seen. From them come the discounted, interpolated
probabilities of all orders. They stand in sorted arrays of grams (four 16-bit code units in one
integer) beside one row of log-probabilities per gram, a column for each language, so that one binary
search answers for all languages. Grams that no language has seen back off through shorter ones.

Where there are more than ``MAX_GRAMS`` counts, Spark computes the same probabilities by joins and writes them
to the shared folder as sorted blocks; tasks read the blocks that their texts ask for and keep some. No gram is left out.

The language with the lowest cross-entropy per character wins. ``score`` is its share among
the languages after a calibrated softmax; ``rejected`` marks texts whose cross-entropy is above what all but
one in a thousand of all training texts show. Both are taken from every training text: tasks score them, Spark adds the
losses of each slope up and counts the cross-entropies by their leading bits, which leads to the exact quantile.

``und`` with score 0 where the text is null, empty or without any letter, or if nothing was learnt.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import batch, new_folder, partitions, runs, store, texts

CHARS_AT_ONCE = 1 << 20
MAX_GRAMS = 1_000_000  # counts that the driver takes; more become a model in the shared folder
BLOCK_ROWS = 1 << 17  # entries of a block there
CACHE_BYTES = 192 << 20  # of blocks that a task's process keeps
DISCOUNT_FLOOR = 0.1
SLOPES = [0.25, 0.5, 1.0, 2.0, 4.0, 8.0]  # of the softmax
REJECT = 0.001
PAD = " " * 3
SCHEMA = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"

LETTER = np.array([chr(i).isalpha() for i in range(65536)])
LETTER[0xD800:0xE000] = True  # halves of characters beyond the first plane


def lowered(text: str) -> bytes:
    """Lower-case 16-bit code units; characters beyond the first plane that are no letters become spaces."""
    x = text.lower()
    raw = x.encode("utf-16-le", "surrogatepass")
    if len(raw) != 2 * len(x):
        x = "".join([c if c < "\U00010000" or c.isalpha() else " " for c in x])
        raw = x.encode("utf-16-le", "surrogatepass")
    return raw


def grams(items: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4-grams of all texts in a row, the text each belongs to, and the number of letters per text.

    A gram ends at every unit but at spaces that follow a space.
    """
    raw, gap = [lowered(x) for x in items], PAD.encode("utf-16-le")
    u = np.frombuffer(gap + gap.join(raw) + gap, np.uint16)
    u = np.where(LETTER[u], u, np.uint16(32))  # whatever is no letter is a space
    w = u.astype(np.uint64)
    g = (w[:-3] << np.uint64(48)) | (w[1:-2] << np.uint64(32)) | (w[2:-1] << np.uint64(16)) | w[3:]
    sizes = np.array([len(x) // 2 for x in raw])
    owner = np.repeat(np.arange(len(items)), sizes + 3)  # the gap after a text is its own
    keep = (u[3:] != 32) | (u[2:-1] != 32)
    letters = np.bincount(owner[u[3:] != 32], minlength=len(items))
    return g[keep], owner[keep], letters


def count(docs: DataFrame) -> DataFrame:
    """(gram, lang, n) over all texts of (text, lang): every task adds up its own first."""
    schema = pa.schema([("gram", pa.int64()), ("lang", pa.string()), ("n", pa.int64())])

    def run(batches):
        held: dict[str, list] = {}

        def flush(lang):
            g = np.concatenate([x for x, _ in held[lang]])
            n = np.concatenate([y for _, y in held[lang]])
            order = np.argsort(g, kind="stable")
            g, n = g[order], n[order]
            first = np.flatnonzero(np.append(True, g[1:] != g[:-1])[: len(g)])
            held[lang] = [(g[first], np.add.reduceat(n, first))]

        for b in batches:
            by: dict[str, list[str]] = {}
            for x, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(x)
            for lang, items in by.items():
                for i, j in runs(items, CHARS_AT_ONCE):
                    g, n = np.unique(grams(items[i:j])[0], return_counts=True)
                    held.setdefault(lang, []).append((g, n))
                    if len(held[lang]) > 16:
                        flush(lang)
                    if len(held[lang][0][0]) > 1_000_000:  # the task's memory stays bounded
                        for g, n in held.pop(lang):
                            yield batch(schema.names, [g.view(np.int64), [lang] * len(g), n], schema)
        for lang in held:
            flush(lang)
            g, n = held[lang][0]
            if not len(g):
                continue
            yield batch(schema.names, [g.view(np.int64), pa.array([lang]).take(pa.array(np.zeros(len(g), np.int64))), n], schema)

    rows = docs.select("text", "lang").mapInArrow(run, "gram long, lang string, n long")
    return rows.groupBy("gram", "lang").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    tables: list[tuple[np.ndarray, np.ndarray]]  # orders 1 to 4: sorted grams, log P per language
    backoffs: list[tuple[np.ndarray, np.ndarray]]  # contexts of 1 to 3: sorted, log of the mass left
    unseen: float
    bound: float = np.inf
    slope: float = 1.0


@dataclass
class Stored:
    """A model whose tables are blocks in the shared folder: 1 to 4 log P by order, 5 to 7 contexts of 1 to 3 units."""

    langs: list[str]
    blocks: dict[int, list[tuple[int, int, str, int, int]]]  # of a table: first and last gram, file, offset, rows
    unseen: float
    bound: float = np.inf
    slope: float = 1.0
    held: OrderedDict = field(default_factory=OrderedDict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"held": OrderedDict()}

    def _block(self, path: str, offset: int, rows: int):
        key = (path, offset)
        if key not in self.held:
            fs, inner = pafs.FileSystem.from_uri(path)
            with fs.open_input_file(inner) as f:
                raw = f.read_at(16 * rows, offset)
            self.held[key] = tuple(
                np.frombuffer(raw, kind, rows, at * rows) for kind, at in (("<i8", 0), ("<i4", 8), ("<f4", 12))
            )
            while len(self.held) > max(1, CACHE_BYTES // (16 * BLOCK_ROWS)):
                self.held.popitem(last=False)
        self.held.move_to_end(key)
        return self.held[key]

    def find(self, table: int, u: np.ndarray) -> np.ndarray:
        """Values of sorted grams, a column per language, nan where there is none."""
        out = np.full((len(u), len(self.langs)), np.nan, np.float32)
        for first, last, path, offset, rows in self.blocks.get(table, ()):
            a, b = np.searchsorted(u, first), np.searchsorted(u, last, side="right")
            if a == b:
                continue
            g, lang, v = self._block(path, offset, rows)
            lo, hi = np.searchsorted(g, u[a:b]), np.searchsorted(g, u[a:b], side="right")
            n = hi - lo
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            out[np.repeat(np.arange(a, b), n), lang[at]] = v[at]
        return out

    def log_p(self, g: np.ndarray, k: int) -> np.ndarray:
        u, inv = np.unique(g.view(np.int64), return_inverse=True)
        p = self.find(k, u)
        rows = np.flatnonzero(np.isnan(p).any(axis=1))
        if len(rows):
            if k == 1:
                low = np.float32(self.unseen)
            else:
                miss = u[rows].view(np.uint64)
                ctx, back = np.unique((miss >> np.uint64(16)).view(np.int64), return_inverse=True)
                low = np.nan_to_num(self.find(3 + k, ctx))[back]
                low = low + self.log_p(miss & np.uint64((1 << (16 * (k - 1))) - 1), k - 1)
            p[rows] = np.where(np.isnan(p[rows]), low, p[rows])
        return p[inv]


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, weights=values, minlength=len(u))


def _one(gram: np.ndarray, n: np.ndarray) -> tuple[list, list, float]:
    """Tables of P and of backoff mass of one language, orders 1 to 4."""
    mask = [np.uint64((1 << (16 * k)) - 1) for k in range(5)]
    order = {4: (gram, n.astype(float))}
    for k in (3, 2, 1):  # continuation counts: how many different units stand before
        g = order[k + 1][0] & mask[k]
        order[k] = _sum_by(g, np.ones(len(g)))
    units_seen = len(order[1][0])
    lower = None
    tables, backoffs = [], []
    for k in (1, 2, 3, 4):
        g, c = order[k]
        once, twice = (c == 1).sum(), (c == 2).sum()
        d = max(DISCOUNT_FLOOR, once / (once + 2 * twice)) if once else DISCOUNT_FLOOR
        d = min(d, 0.9)
        ctx = g >> np.uint64(16)
        u, inv = np.unique(ctx, return_inverse=True)
        total = np.bincount(inv, weights=c)
        left = d * np.bincount(inv) / total
        if k == 1:
            p = np.maximum(c - d, 0) / total[inv] + left[inv] / (units_seen + 1)
            unseen = float(left[0] / (units_seen + 1))
        else:
            lg, lp = lower
            p = np.maximum(c - d, 0) / total[inv] + left[inv] * lp[np.searchsorted(lg, g & mask[k - 1])]
            backoffs.append((u, left))
        tables.append((g, p))
        lower = (g, p)
    return tables, backoffs, unseen


def learn(counts: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Model from (language, grams, counts)."""
    ones = [(lang, *_one(*(x[np.argsort(g)] for x in (g, n)))) for lang, g, n in counts if len(g)]
    langs = [x[0] for x in ones]
    unseen = float(np.log(min((x[3] for x in ones), default=1e-6)))
    model = Model(langs, [], [], unseen)
    for k in range(3):  # mass left after contexts of 1 to 3 units; 1 where never seen
        u = np.unique(np.concatenate([x[2][k][0] for x in ones]))
        w = np.zeros((len(u), len(ones)))
        for j, x in enumerate(ones):
            w[np.searchsorted(u, x[2][k][0]), j] = np.log(x[2][k][1])
        model.backoffs.append((u, w.astype(np.float32)))
    for k in range(4):
        u = np.unique(np.concatenate([x[1][k][0] for x in ones]))
        p = _backed_off(model, u, k + 1).astype(np.float64)
        for j, x in enumerate(ones):
            p[np.searchsorted(u, x[1][k][0]), j] = np.log(x[1][k][1])
        model.tables.append((u, p.astype(np.float32)))
    return model


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, table[at] == keys


def _backed_off(model: Model, g: np.ndarray, k: int) -> np.ndarray:
    """log P of grams of order k by the orders below it."""
    if k == 1:
        return np.full((len(g), len(model.langs)), model.unseen, np.float32)
    u, w = model.backoffs[k - 2]
    at, hit = _find(u, g >> np.uint64(16))
    out = np.where(hit[:, None], w[at], np.float32(0))
    return out + log_p(model, g & np.uint64((1 << (16 * (k - 1))) - 1), k - 1)


def log_p(model: Model | Stored, g: np.ndarray, k: int = 4) -> np.ndarray:
    """log P of each gram's last unit after the units before it, a column per language."""
    if isinstance(model, Stored):
        return model.log_p(g, k)
    u, p = model.tables[k - 1]
    at, hit = _find(u, g)
    out = p[at]
    if not hit.all():
        miss = np.flatnonzero(~hit)
        out[miss] = _backed_off(model, g[miss], k)
    return out


def entropies(model: Model | Stored, items: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy per character of each text in each language, characters and letters counted."""
    total = np.zeros((len(items), len(model.langs)))
    size, letters = np.zeros(len(items)), np.zeros(len(items), np.int64)
    cut = [(i, x[a : a + CHARS_AT_ONCE]) for i, x in enumerate(items) for a in range(0, len(x), CHARS_AT_ONCE)]
    for a, b in runs([x for _, x in cut], CHARS_AT_ONCE):
        g, owner, n = grams([x for _, x in cut[a:b]])
        ids = np.array([i for i, _ in cut[a:b]])
        np.add.at(letters, ids, n)
        if len(g):
            p = log_p(model, g)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sums = np.add.reduceat(p, first, axis=0, dtype=np.float64)
            np.add.at(total, ids[owner[first]], sums)
            np.add.at(size, ids, np.bincount(owner, minlength=b - a))
    return -total / np.maximum(size, 1)[:, None], size, letters


def _softmax(slope: float, e: np.ndarray, size: np.ndarray) -> np.ndarray:
    z = -(e - e.min(axis=1, keepdims=True)) * slope * np.sqrt(size)[:, None]
    z = np.exp(z)
    return z / z.sum(axis=1, keepdims=True)


def _write(rows: DataFrame, folder: str) -> DataFrame:
    """(tab, first, last, path, start, n): blocks of (tab, gram, lang, v) that are sorted in their partitions."""
    schema = pa.schema(
        [("tab", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("path", pa.string()), ("start", pa.int64()), ("n", pa.int64())]
    )

    def run(batches):
        path, out, done, index, held, size = f"{folder}/{uuid.uuid4().hex}", None, 0, [], [], 0

        def put():
            nonlocal out, done, held, size
            tab, g, lang, v = (np.concatenate(x) for x in zip(*held, strict=True))
            cuts = np.append(np.flatnonzero(np.append(True, tab[1:] != tab[:-1])), len(tab))
            for x, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                for i in range(x, end, BLOCK_ROWS):
                    j = min(i + BLOCK_ROWS, end)
                    if out is None:
                        fs, inner = pafs.FileSystem.from_uri(path)
                        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                        out = fs.open_output_stream(inner)
                    out.write(g[i:j].astype("<i8").tobytes() + lang[i:j].astype("<i4").tobytes() + v[i:j].astype("<f4").tobytes())
                    index.append((int(tab[i]), int(g[i]), int(g[j - 1]), path, done, j - i))
                    done += 16 * (j - i)
            held, size = [], 0

        for b in batches:
            held.append([b.column(i).to_numpy() for i in range(4)])
            size += b.num_rows
            if size >= BLOCK_ROWS:
                put()
        if size:
            put()
        if out is not None:
            out.close()
            yield batch(schema.names, zip(*index, strict=True), schema)

    return rows.mapInArrow(run, "tab int, first long, last long, path string, start long, n long")


def learn_stored(counts: DataFrame, parts: int) -> Stored:
    """As ``learn``, of all rows of (gram, lang, n), by Spark."""
    spark = counts.sparkSession
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    numbers = F.broadcast(spark.createDataFrame(list(enumerate(names)), "lang int, name string"))
    ours = counts.withColumnRenamed("lang", "name").join(numbers, "name").select("gram", "lang", F.col("n").cast("double").alias("c"))
    order = {4: store(ours, "grams")}
    for k in (3, 2, 1):  # continuation counts: how many different units stand before
        low = F.col("gram").bitwiseAND(F.lit((1 << (16 * k)) - 1)).alias("gram")
        order[k] = store(order[k + 1].groupBy(low, "lang").agg(F.count("*").cast("double").alias("c")), "grams")
    tables, lower, unseen = [], None, 0.0
    for k in (1, 2, 3, 4):
        one, two = (F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2))
        seen = []
        for r in order[k].groupBy("lang").agg(one, two, F.count("*").alias("units")).collect():
            d = max(DISCOUNT_FLOOR, r["n1"] / (r["n1"] + 2 * r["n2"])) if r["n1"] else DISCOUNT_FLOOR
            seen.append((r["lang"], min(d, 0.9), r["units"]))
        known = F.broadcast(spark.createDataFrame(seen, "lang int, d double, units long"))
        rows = order[k].withColumn("ctx", F.shiftrightunsigned("gram", 16)).join(known, "lang")
        left = rows.groupBy("ctx", "lang").agg(F.sum("c").alias("total"), (F.max("d") * F.count("*") / F.sum("c")).alias("left"))
        rows = rows.join(left, ["ctx", "lang"])
        share = F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")
        if k == 1:
            rows = rows.withColumn("rest", F.col("left") / (F.col("units") + 1))
            unseen = float(np.log(rows.agg(F.min("rest")).first()[0]))
            rows = rows.select("gram", "lang", (share + F.col("rest")).alias("p"))
        else:
            below = lower.select(F.col("gram").alias("low"), "lang", F.col("p").alias("low_p"))
            rows = rows.withColumn("low", F.col("gram").bitwiseAND(F.lit((1 << (16 * (k - 1))) - 1))).join(below, ["low", "lang"])
            rows = rows.select("gram", "lang", (share + F.col("left") * F.col("low_p")).alias("p"))
            tables.append(left.select(F.lit(3 + k).alias("tab"), F.col("ctx").alias("gram"), "lang", F.log("left").cast("float").alias("v")))
        lower = store(rows, "grams")
        tables.append(lower.select(F.lit(k).alias("tab"), "gram", "lang", F.log("p").cast("float").alias("v")))
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    rows = rows.repartitionByRange(parts, "tab", "gram", "lang").sortWithinPartitions("tab", "gram", "lang")
    blocks: dict[int, list] = {}
    for r in sorted(map(tuple, _write(rows, new_folder(spark, "langid")).collect())):
        blocks.setdefault(r[0], []).append(r[1:])
    return Stored(names, blocks, unseen)


def _scored(train: DataFrame, model: Model | Stored) -> DataFrame:
    """(low, losses) of every training text with a letter: the bits of its lowest cross-entropy, its loss at each slope."""
    schema = pa.schema([("low", pa.int64()), ("losses", pa.list_(pa.float64()))])
    shared = train.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for b in batches:
            e, size, letters = entropies(model, b.column(0).to_pylist())
            ok = np.flatnonzero(letters > 0)
            if not len(ok):
                continue
            e, size = e[ok], size[ok]
            at = np.array([model.langs.index(x) for x in b.column(1).take(pa.array(ok)).to_pylist()])
            losses = []
            for slope in SLOPES:
                p = _softmax(slope, e, size)[np.arange(len(e)), at]
                losses.append(-np.log(np.maximum(p, 1e-9)))
            low = np.maximum(e.min(axis=1), 0.0) + 0.0  # of numbers not below 0, the bits sort as they do
            yield batch(schema.names, [low.view(np.int64), np.column_stack(losses).tolist()], schema)

    return train.select("text", "lang").mapInArrow(run, "low long, losses array<double>")


def _nth(rows: DataFrame, n: int) -> float:
    """The n-th smallest (from 0) of the numbers whose bits are in ``low``, by counts of 16 bits at a time."""
    head = 0
    for shift in (48, 32, 16, 0):
        inside = rows if shift == 48 else rows.where(F.shiftright("low", shift + 16) == head)
        counts = inside.groupBy(F.shiftright("low", shift).alias("head")).agg(F.count("*").alias("n"))  # at most 65,536 rows
        for r in sorted(counts.collect()):
            if n < r["n"]:
                head = r["head"]
                break
            n -= r["n"]
    return float(np.array([head], np.int64).view(np.float64)[0])


def _calibrate(train: DataFrame, model: Model | Stored) -> None:
    """Set the bound and the slope of the model from all training texts."""
    scored = store(_scored(train, model), "scored")
    n, *losses = scored.agg(F.count("*"), *(F.sum(F.col("losses")[i]) for i in range(len(SLOPES)))).first()
    if not n:
        return
    place = (1 - REJECT) * (n - 1)
    least = _nth(scored, int(place))
    most = _nth(scored, min(int(place) + 1, n - 1))
    model.bound = least + (most - least) * (place - int(place))
    model.slope = SLOPES[int(np.argmin(losses))]


def fit(docs: DataFrame, keep: Column, lang_col: str = "lang") -> Model | Stored | None:
    """Learn from every kept text with a language. None if there is no such text."""
    train = docs.where(keep & F.col(lang_col).isNotNull() & F.col("text").isNotNull())
    train = train.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(lang_col).alias("lang"))
    parts = partitions(train)
    counts = count(train).repartition(parts, "gram").persist()
    try:
        n = counts.count()
        if not n:
            return None
        if n > MAX_GRAMS:
            model = learn_stored(counts, parts)
        else:
            got = counts.toPandas()
            model = learn(
                [(lang, x.gram.to_numpy().view(np.uint64), x.n.to_numpy()) for lang, x in got.groupby("lang", sort=True)]
            )
    finally:
        counts.unpersist()
    _calibrate(train, model)
    return model


def predict(docs: DataFrame, model: Model | Stored | None) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) of every whole text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for b in batches:
            items = b.column(1).to_pylist()
            if model is None or not items:
                n = len(items)
                yield batch(schema.names, [b.column(0), ["und"] * n, [0.0] * n, [None] * n, [True] * n], schema)
                continue
            e, size, letters = entropies(model, items)
            best, ok = e.argmin(axis=1), letters > 0
            low = e[np.arange(len(items)), best]
            p = _softmax(model.slope, e, size).max(axis=1)
            lang = [model.langs[i] if k else "und" for i, k in zip(best, ok, strict=True)]
            yield batch(
                schema.names,
                [b.column(0), lang, np.where(ok, p, 0), pa.array(low, mask=~ok), (low > model.bound) | ~ok],
                schema,
            )

    return texts(docs).mapInArrow(run, SCHEMA)
