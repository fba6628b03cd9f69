"""Quality by compression: a text that good examples help to compress is a good one.

Two zstandard dictionaries are trained, one on good and one on bad texts. The difference of
the two compressed sizes, divided by the size of the text, is the only feature; a logistic
fit on other labelled texts turns it into a probability.

Examples are the whole texts of a bounded number of labelled rows. For the dictionaries they are cut into pieces of some
kilobytes; where the pieces of a class are more than the trainer is given, a hash picks them from anywhere in the texts.
The sizes that calibrate are those of whole texts and are computed in tasks.

Empty texts, and any text if a class has too few examples for a dictionary, get the share of
good examples (0.5 without any label). Rows with a null id are scored too; rows are never
dropped and repeated rows come out repeatedly. Ids labelled both ways take no part in the fit; rows with a null id are in
no fold of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import batch, labelled_rows, logistic, share, sigmoid, store, texts, to_share

SAMPLE_ROWS = 4_000  # of each class: two thirds for the dictionaries, one for the calibration
PIECE = 4_096  # characters of a piece of an example for a dictionary
TRAIN_PIECES = 4_096  # of each class, for the dictionaries
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
# Fixed for the trainer: left to search for them, it can settle on a dictionary of a few kilobytes.
TRAINER = {"k": 256, "d": 8}
SCHEMA = "doc_id long, difference double, score double"


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float


class Sizes:
    """Compressors that share nothing with the session; made once per task."""

    def __init__(self, model: Model):
        self.pair = []
        for content in (model.good, model.bad):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT)
            d.precompute_compress(level=LEVEL)
            self.pair.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=True))

    def difference(self, text: str) -> float:
        """Bytes the good dictionary saves over the bad one, per byte of the text."""
        raw = text.encode("utf-8", "surrogatepass")
        good, bad = (len(c.compress(raw)) for c in self.pair)
        return (bad - good) / (len(raw) + 1)


def _pieces(chosen: DataFrame, label: int, pieces: int) -> list[bytes]:
    """About ``pieces`` pieces of the whole texts of a class, or all where there are fewer."""
    cuts = F.sequence(F.lit(1), F.length("text"), F.lit(PIECE))
    found = chosen.where(F.col("label") == label).select("doc_id", "text", F.posexplode(cuts).alias("i", "_from"))
    n = chosen.where(F.col("label") == label).agg(F.sum(F.ceil(F.length("text") / PIECE))).first()[0] or 0
    if n > pieces:
        parts = 1 << 30
        found = found.where(F.pmod(F.xxhash64("doc_id", "i"), F.lit(parts)) < int(parts * pieces / n))
    rows = found.select("doc_id", "i", F.substring("text", F.col("_from"), F.lit(PIECE)).alias("piece")).collect()
    return [r["piece"].encode() for r in sorted(rows, key=lambda r: (r["doc_id"], r["i"]))]


def _differences(rest: DataFrame, model: Model) -> list[tuple[int, float]]:
    """(label, difference) of the whole texts that calibrate."""
    schema = pa.schema([("label", pa.int32()), ("difference", pa.float64())])

    def run(batches):
        sizes = Sizes(model)
        for b in batches:
            yield batch(schema.names, [b.column(0), [sizes.difference(x.as_py()) for x in b.column(1)]], schema)

    rows = rest.select("label", "text").mapInArrow(run, "label int, difference double").collect()
    return sorted((r["label"], r["difference"]) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Train on the whole texts of about ``rows`` labelled documents of either class, chosen by the hash of their id."""
    sample = store(labelled_rows(docs, labels, label, keep, rows), "quality-examples")
    prior = 0.5 if sample.isEmpty() else share(labels, label, keep)
    chosen = sample.where("part > 0")
    try:
        dictionaries = [
            zstandard.train_dictionary(DICTIONARY_BYTES, _pieces(chosen, k, TRAIN_PIECES), level=LEVEL, **TRAINER).as_bytes()
            for k in (1, 0)
        ]
    except (zstandard.ZstdError, ValueError):  # too few or too small examples
        return Model(b"", b"", (0.0, 0.0), prior)
    rest = _differences(sample.where("part = 0"), Model(*dictionaries, (0.0, 0.0), prior))
    y = np.array([v for v, _ in rest])
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", (0.0, 0.0), prior)
    w = to_share(logistic(np.array([d for _, d in rest])[:, None] * 100, y), y, prior)
    return Model(*dictionaries, w, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, difference, score) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("difference", pa.float64()), ("score", pa.float64())])

    def run(batches):
        sizes = Sizes(model) if model.good else None
        for b in batches:
            found = [sizes.difference(t) if sizes and t else None for t in b.column(1).to_pylist()]
            a, c = model.weights
            p = [model.prior if d is None else float(sigmoid(a + c * 100 * d)) for d in found]
            yield batch(schema.names, [b.column(0), found, p], schema)

    return texts(docs).mapInArrow(run, SCHEMA)
