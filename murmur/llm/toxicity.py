"""Toxicity by a weighted lexicon, found with one Aho-Corasick automaton over folded text.

Folding undoes disguises: compatibility forms, look-alike letters of other scripts, accents,
digits and signs used as letters, and letters drawn out. Words stand between single spaces in
the folded text, so that an entry " word " is a whole word and " stem" a beginning of words.

The lexicon is learnt from the whole texts of a bounded number of labelled rows; tasks reduce each text to its words, stems
and phrases, Spark adds these up, and the driver gets those that pass the bounds on counts. It holds stems and words
whose share among toxic examples is far above their share among clean ones. Exceptions are learnt too: two-word phrases that hold an entry but occur among
clean examples mostly; a hit inside an exception does not count. The weights of all
other hits are summed, divided by a power of the length, and calibrated by a logistic fit on
examples that had no part in the choice of the lexicon.

A text without a hit, an empty one included, gets the score of no evidence. Without labelled examples
the lexicon is empty and all texts have the share of toxic examples (0 without any). Ids labelled both ways take no part in the
fit. Rows with a null id are scored too, and are in no fold of labelled rows.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import batch, labelled_rows, logistic, share, sigmoid, store, texts, to_share

SAMPLE_ROWS = 6_000  # of each class: two thirds choose the lexicon, the rest calibrate
MIN_TEXTS = 6
MIN_WEIGHT = 2.5
STEMS = (4, 5, 6, 7)
LENGTH_POWER = 0.5
HELD = 1 << 18  # counts a task keeps before it passes them on
SCHEMA = "doc_id long, hits int, density double, score double"

# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "аеорсухівкмнтгԁԛѕјһαβεικνορτυχωγηο",
        "aeopcyxibkmhtrdqsjhabeiknoptuxwyno",
        strict=True,
    )
)
# Digits and signs that stand for letters inside a word.
DIGITS = dict(zip("01345789@$!|+", "oieastbgasiit", strict=True))
SIGNS = re.compile(r"[0-9@$!|+]")
SPLIT = re.compile(r"[\W_]+")
DRAWN = re.compile(r"(.)\1{2,}")
PLAIN = str.maketrans(LOOKALIKES)


SPELLED = str.maketrans(DIGITS)


def _undo(word: str) -> str:
    """A word with digits or signs among its letters, spelled with letters."""
    core = word.strip(".,;:!?|+()[]{}\"'*&%#-")
    if len(core) >= 3 and any(c.isalpha() for c in core) and SIGNS.search(core):
        return core.translate(SPELLED)
    return word


def fold_text(text: str) -> str:
    """The text as words between single spaces, without disguises."""
    x = text.lower()
    if not x.isascii():
        x = unicodedata.normalize("NFKD", x).translate(PLAIN)
        if not x.isascii():
            x = "".join(c for c in x if not unicodedata.combining(c))
    if SIGNS.search(x):
        x = " ".join([_undo(w) if SIGNS.search(w) else w for w in x.split()])
    x = DRAWN.sub(r"\1\1", x)
    return f" {SPLIT.sub(' ', x).strip()} "


@dataclass
class Model:
    entries: dict[str, float]  # " word " or " stem" -> weight
    exceptions: tuple[str, ...]  # " two words "
    weights: tuple[float, ...]
    prior: float


def _features(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if len(w) >= n)
    return out


def _counted(sample: DataFrame, of: Callable[[str], set[str]]) -> DataFrame:
    """(feature, n0, n1): in how many clean and toxic examples each feature occurs."""
    schema = pa.schema([("feature", pa.string()), ("n0", pa.int64()), ("n1", pa.int64())])

    def flush(counts):
        names = list(counts[0].keys() | counts[1].keys())
        return batch(schema.names, [names, *([c[f] for f in names] for c in counts)], schema)

    def run(batches):
        counts = (Counter(), Counter())
        for b in batches:
            for x, y in zip(b.column(0), b.column(1)):
                counts[y.as_py()].update(of(x.as_py()))
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield flush(counts)
                    counts = (Counter(), Counter())
        yield flush(counts)

    found = sample.select("folded", "label").mapInArrow(run, "feature string, n0 long, n1 long")
    return found.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _entries(sample: DataFrame) -> dict[str, float]:
    """Words and stems with their weights; an entry that a shorter stem covers as well adds nothing."""
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    clean, toxic = size.get(0, 0), size.get(1, 0)
    # clean texts count with two more than seen, so that rare chance finds weigh little
    weight = F.log(F.col("n1") / (toxic + 1)) - F.log((F.col("n0") + 0.5) / (clean + 1))
    # how often chance would put the feature into so many more toxic texts
    expected = (F.col("n0") + F.col("n1")) * (toxic / max(clean + toxic, 1))
    found = _counted(sample, _features).where(F.col("n1") >= MIN_TEXTS).withColumns({"weight": weight, "expected": expected})
    found = found.where((F.col("weight") >= MIN_WEIGHT) & ((F.col("n1") - F.col("expected")) ** 2 > 12 * F.col("expected")))
    entries: dict[str, float] = {}
    for r in sorted(found.collect(), key=lambda r: (-r["weight"] * r["n1"], r["feature"])):
        f = r["feature"]
        stem = f.rstrip()
        if not any(stem[:n] in entries for n in range(2, len(stem) + (f != stem))):
            entries[f] = r["weight"]
    return entries


def _spared(sample: DataFrame, entries: dict[str, float]) -> tuple[str, ...]:
    """Phrases of two words that hold an entry and are those of clean examples."""

    def entry(w: str) -> bool:
        return f" {w} " in entries or any(f" {w[:n]}" in entries for n in STEMS)

    def phrases(folded: str) -> set[str]:
        words = folded.split()
        held = {w for w in set(words) if entry(w)}
        return {f" {a} {b} " for a, b in zip(words, words[1:]) if a in held or b in held}

    found = _counted(sample, phrases).where("n0 >= 3 AND n0 > 3 * n1").select("feature").collect()
    return tuple(sorted(r["feature"] for r in found))


class Finder:
    """The automaton of a model."""

    def __init__(self, model: Model):
        self.machine = ahocorasick.Automaton()
        for f, w in model.entries.items():
            self.machine.add_word(f, (len(f), w))
        for p in model.exceptions:
            self.machine.add_word(p, (len(p), None))
        self.any = len(self.machine) > 0
        if self.any:
            self.machine.make_automaton()

    def find(self, text: str) -> tuple[int, float]:
        """Number of hits and their weight over a power of the number of words."""
        return self.find_folded(fold_text(text)) if self.any and text else (0, 0.0)

    def find_folded(self, folded: str) -> tuple[int, float]:
        hits, spared = {}, []
        if not self.any:
            return 0, 0.0
        for end, (n, w) in self.machine.iter(folded):
            start = end - n + 1
            if w is None:
                spared.append((start, end + 1))
            elif w > hits.get(start, 0):  # of a word's entries the heaviest counts
                hits[start] = w
        if spared:
            spared.sort()
            starts = [a for a, _ in spared]
            ends = [0, *accumulate((b for _, b in spared), max)]  # the farthest end of all that start so early
            hits = {p: w for p, w in hits.items() if ends[bisect_right(starts, p)] <= p + 1}
        if not hits:
            return 0, 0.0
        return len(hits), sum(hits.values()) / (20 + folded.count(" ")) ** LENGTH_POWER


def _columns(found: list[tuple[int, float]]) -> np.ndarray:
    hits, density = np.array(found, dtype=float).reshape(-1, 2).T
    return np.column_stack([np.log1p(density * 10), np.minimum(hits, 3)])


def _folded(rows: DataFrame) -> DataFrame:
    """(label, part, folded) of examples."""
    schema = pa.schema([("label", pa.int32()), ("part", pa.int32()), ("folded", pa.string())])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):  # one at a time: these are whole texts
                yield batch(schema.names, [b.column(0)[i : i + 1], b.column(1)[i : i + 1], [fold_text(b.column(2)[i].as_py())]], schema)

    return rows.select("label", "part", "text").mapInArrow(run, "label int, part int, folded string")


def _found(sample: DataFrame, model: Model) -> list[tuple[int, int, float]]:
    """(label, hits, density) of the examples that calibrate."""
    schema = pa.schema([("label", pa.int32()), ("hits", pa.int32()), ("density", pa.float64())])

    def run(batches):
        finder = Finder(model)
        for b in batches:
            found = [finder.find_folded(x.as_py()) for x in b.column(1)]
            yield batch(schema.names, [b.column(0), [n for n, _ in found], [d for _, d in found]], schema)

    rows = sample.select("label", "folded").mapInArrow(run, "label int, hits int, density double").collect()
    return sorted((r["label"], r["hits"], r["density"]) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the whole texts of about ``rows`` labelled documents of either class, chosen by the hash of their id."""
    sample = store(_folded(labelled_rows(docs, labels, label, keep, rows)), "toxicity-examples")
    seen = sorted(r["label"] for r in sample.select("label").distinct().collect())
    if len(seen) < 2:
        return Model({}, (), (), float(seen[0]) if seen else 0.0)
    prior = share(labels, label, keep)
    chosen = sample.where("part > 0")
    entries = _entries(chosen)
    model = Model(entries, _spared(chosen, entries) if entries else (), (), prior)
    rest = _found(sample.where("part = 0"), model)
    y = np.array([v for v, _, _ in rest])
    if len(set(y.tolist())) < 2:
        return Model({}, (), (), prior)
    w = logistic(_columns([(n, d) for _, n, d in rest]), y)
    return Model(entries, model.exceptions, to_share(w, y, prior), prior)


def _scores(finder: Finder, model: Model, items: list[str]) -> tuple[list, np.ndarray]:
    found = [finder.find(t) for t in items]
    if model.weights and found:
        return found, sigmoid(model.weights[0] + _columns(found) @ np.array(model.weights[1:]))
    return found, np.full(len(found), model.prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, hits, density, score) of every whole text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("hits", pa.int32()), ("density", pa.float64()), ("score", pa.float64())]
    )

    def run(batches):
        finder = Finder(model)
        for b in batches:
            found, p = _scores(finder, model, b.column(1).to_pylist())
            yield batch(schema.names, [b.column(0), [n for n, _ in found], [d for _, d in found], p], schema)

    return texts(docs).mapInArrow(run, SCHEMA)


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score): every row of the table with all its columns in ``row``, and its score."""
    packed = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        finder = Finder(model)
        for b in batches:
            p = _scores(finder, model, b.column(1).to_pylist())[1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], ["row", "score"])

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())]))
