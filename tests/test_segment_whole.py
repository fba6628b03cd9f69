"""Segmentation of whole texts in which frequent words are rewritten in Han characters, token by token."""

import re
import unicodedata

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from murmur.operators.tokens import segment

D = "/root/testdata/sf0.01"
SWAP = {"the": "自由", "of": "自由自在", "and": "在"}
LEXICON = ["自由", "自由自在", "由自", "ABC自由", "The"]  # letters in a word are no part of a run


def words(text):
    """Runs of letters, marks and digits; Han runs cut by longest match from the left."""
    out, i, known = [], 0, {"自由", "自由自在", "由自"}
    while i < len(text):
        c = text[i]
        if "一" <= c <= "鿿":
            n = next((k for k in (4, 2) if text[i : i + k] in known), 1)
            out.append(text[i : i + n])
            i += n
        elif unicodedata.category(c)[0] in "LM" or unicodedata.category(c) in ("Nd", "Nl", "No"):
            j = i
            while j < len(text) and not "一" <= text[j] <= "鿿" and (unicodedata.category(text[j])[0] in "LMN"):
                j += 1
            out.append(text[i:j])
            i = j
        else:
            i += 1
    return out


def test_whole_texts(spark):
    rows = [(r["doc_id"], re.sub(r"\b(the|of|and)\b *", lambda m: SWAP[m[1].lower()], r["text"] or "", flags=re.I)) for r in pq.read_table(f"{D}/documents.parquet").to_pylist()[:200]]
    rows += [(-1, "自由自在自由x1自, 由自由! 12自由34"), (-2, ""), (-3, "...")]
    docs = spark.createDataFrame(rows, "doc_seq long, content string").withColumn("site", F.concat(F.lit("s"), "doc_seq"))
    lexicon = spark.createDataFrame([(w,) for w in LEXICON], "word string")
    got = {}
    for r in segment(docs, lexicon, "doc_seq", carry=["site"]).collect():
        assert r.site == f"s{r.doc_seq}"
        got.setdefault(r.doc_seq, []).append((r.pos, r.token))
    want = {i: w for i, t in rows if (w := list(enumerate(words(t.lower()))))}
    assert sum("自由自在" in dict(map(reversed, w)) for w in want.values()) > 100
    assert {i: sorted(w) for i, w in got.items()} == want
