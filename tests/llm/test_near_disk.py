"""What near-duplicates move and leave behind: no texts and sketches that no comparison asks for."""

import os
import random

from pyspark.sql import functions as F

from murmur.llm import chosen_path, common
from murmur.session import shared_dir


def docs(spark, n=600):
    r = random.Random(3)
    rows = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(60))) for i in range(n)]
    rows += [(n + i, rows[i][1] + " end") for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_among(spark):
    rows = spark.range(-50_000, 50_000).withColumn("text", F.lit("x"))
    wanted = spark.range(-50_000, 50_000, 17)
    got = common.among(rows, "id", wanted)
    assert got.columns == rows.columns
    found = {r.id for r in got.collect()}
    assert set(range(-50_000, 50_000, 17)) <= found and len(found) < 7_000
    assert common.among(rows, "id", wanted.where("id > 60000")).count() == 0


def test_scratch_is_dropped(spark):
    folder = shared_dir(spark)
    before = set(os.listdir(folder))
    out = chosen_path.near_duplicates(docs(spark))
    new = set(os.listdir(folder)) - before
    assert {x.rsplit("-", 1)[0] for x in new} <= {"rows", "links"}
    got = {r.doc_id: r.component_id for r in out.collect()}
    assert len(got) == 620 and all(got[600 + i] == i for i in range(20))


def test_only_texts_asked_for_move(spark, monkeypatch):
    seen, sizes, real, full = [], [], chosen_path.among, chosen_path._likely

    def among(rows, key, wanted):
        seen.append(real(rows, key, wanted).count())
        return real(rows, key, wanted)

    def likely(rows, n, percent):
        sizes.append(rows.agg(F.max(F.octet_length("sketch"))).first()[0])
        return full(rows, n, percent)

    monkeypatch.setattr(chosen_path, "among", among)
    monkeypatch.setattr(chosen_path, "_likely", likely)
    chosen_path.near_duplicates(docs(spark)).collect()
    assert seen and max(seen) < 100
    assert max(x for x in sizes if x) == chosen_path.PLACES
