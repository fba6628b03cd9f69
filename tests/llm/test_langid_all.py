"""The bound and the slope come from every training text, not from a sample."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.llm import langid


@pytest.mark.parametrize("limit", [langid.MAX_GRAMS, 10])
def test_bound_and_slope_of_all_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(langid, "MAX_GRAMS", limit)
    rng = np.random.default_rng(3)
    words = ["the", "cat", "sat", "on", "der", "hund", "lief", "mat"]
    rows = [(i, " ".join(rng.choice(words, 3 + i % 9)), "en" if i % 2 else "de") for i in range(2600)]
    rows += [(3000 + i, "".join(chr(97 + x) for x in rng.integers(0, 26, 40)), "en") for i in range(4)] + [(4000, "12 !", "de"), (None, "no id here", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = langid.fit(docs, F.lit(True))
    e, size, letters = langid.entropies(model, [t for _, t, _ in rows])
    ok = letters > 0
    assert np.isclose(model.bound, np.quantile(e[ok].min(axis=1), 1 - langid.REJECT), rtol=1e-12)
    at = np.array([model.langs.index(x) for _, _, x in rows])[ok]
    losses = [-np.log(np.maximum(langid._softmax(s, e[ok], size[ok])[np.arange(ok.sum()), at], 1e-9)).mean() for s in langid.SLOPES]
    assert model.slope == langid.SLOPES[int(np.argmin(losses))]
