"""A model gets bounded stretches of a batch, whatever the number and size of its texts."""

from pyspark.sql import functions as F

from murmur.operators import annotate as ann


def test_model_gets_bounded_stretches(spark):
    def factory():
        def model(texts):
            seen = sum(len(t) for t in texts)
            return [([t[:3]], [str(seen) if len(texts) > 1 else "1"], []) for t in texts]

        return model

    docs = spark.range(3000).coalesce(1).select(F.col("id").cast("string").alias("url"), F.concat(F.lpad(F.col("id").cast("string"), 4, "0"), F.expr("repeat('x', 2000)")).alias("content"))
    docs = docs.unionByName(spark.createDataFrame([("long", "y" * 2_000_000)], "url string, content string"))
    rows = ann.annotate(docs, factory).collect()
    assert len(rows) == 3001 and {r.url for r in rows} == {"long", *map(str, range(3000))}
    assert all(r.words == [r.url.zfill(4)[:3]] for r in rows if r.url != "long")
    assert max(int(r.pos[0]) for r in rows) <= 1 << 19  # a batch of 3,000 texts came as one before


def test_slices():
    assert [(x.start, x.stop) for x in ann.slices(["ab", "c", "", "defg", "h"], 3)] == [(0, 3), (3, 4), (4, 5)]
    assert list(ann.slices([], 3)) == []
