"""Language models too large for the driver: all grams stay, with the probabilities of the model in memory."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.llm import langid

ROWS = [(i, "the cat sat on the mat and the dog ran %d" % i, "en") for i in range(40)]
ROWS += [(100 + i, "der Hund lief über die Straße und die Katze %d" % i, "de") for i in range(40)]
ROWS += [(200, "nimi sina li pona tawa mi", "tok"), (201, "自由自在的人", "zh"), (202, "𠀀𠀁 12 ﹿ￿ő", "zh"), (203, "12 !", "none")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string")


def test_stored_model_equals_the_one_in_memory(spark, docs, monkeypatch):
    plain = langid.fit(docs, F.lit(True))
    monkeypatch.setattr(langid, "MAX_GRAMS", 10)
    monkeypatch.setattr(langid, "BLOCK_ROWS", 64)
    stored = langid.fit(docs, F.lit(True))
    assert isinstance(plain, langid.Model) and isinstance(stored, langid.Stored)
    assert plain.langs == stored.langs and "tok" in stored.langs
    g = langid.grams([t for _, t, _ in ROWS] + ["quite other words, ganz andere", "自在 x"])[0]
    assert np.allclose(langid.log_p(plain, g), langid.log_p(stored, g), atol=1e-4)
    assert np.isclose(plain.bound, stored.bound, atol=1e-4) and plain.slope == stored.slope
    key = lambda m: sorted((r.doc_id, r.lang_pred, round(r.score, 3), r.rejected) for r in langid.predict(docs, m).collect())
    assert key(plain) == key(stored)
    assert {r.doc_id: r.lang_pred for r in langid.predict(docs, stored).collect()}[200] == "tok"
