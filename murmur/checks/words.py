"""Tokens, keywords and emotions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from murmur.checks import inputs as src
from murmur.checks.nested import CLEAN
from murmur.checks.registry import query
from murmur.functions.text import is_valid_keyword, pack_word_pos
from murmur.operators import annotate as ann
from murmur.operators import emotion, keywords, sentiment
from murmur.operators.joins import literal_table
from murmur.operators.tables import union_sources
from murmur.operators.tokens import segment, segment_probable, tokenize, word_frequency_map
from murmur.plans import daily
from murmur.session import scratch


def _keyword_tokens(spark, sf):
    return daily.keyword_tokens(src.raw_documents(spark, sf), src.AS_OF)


def _emotion_tokens(spark, sf):
    return daily.emotion_tokens(daily.emotion_articles(src.raw_documents(spark, sf)))


def _emotion_docs(spark, sf):
    return daily.emotion_articles(src.raw_documents(spark, sf))


KEYWORDS = src.TOKENS + f""",
{src.STOP},
counts AS (
  SELECT publish_date, source, token AS keyword, count(*) AS cnt, min((doc_seq, pos)) AS seen
  FROM tokens GROUP BY ALL),
kept AS (SELECT * FROM counts WHERE keyword NOT IN (SELECT word FROM stop) AND keyword <> '')
"""


@query(f"""WITH {KEYWORDS}
SELECT publish_date, source, CAST(rank AS INTEGER) AS rank, keyword, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY publish_date, source ORDER BY cnt DESC, keyword) AS rank
  FROM kept) WHERE rank <= 15""")
def daily_keywords_top15(spark, sf):
    return daily.daily_keywords(src.raw_documents(spark, sf), src.stopwords(spark), src.AS_OF)


@query(f"""WITH {KEYWORDS}
SELECT publish_date, source, CAST(rank AS INTEGER) AS rank, keyword, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY publish_date, source ORDER BY cnt DESC, seen) AS rank
  FROM kept) WHERE rank <= 15""")
def daily_keywords_first_seen(spark, sf):
    return daily.daily_keywords(
        src.raw_documents(spark, sf), src.stopwords(spark), src.AS_OF, tie="first_seen"
    )


@query(f"""WITH {KEYWORDS},
one AS (
  SELECT row_number() OVER (ORDER BY cnt DESC, keyword) AS rank, keyword, cnt
  FROM kept WHERE publish_date = DATE '2024-01-05' AND source = 'PTT')
SELECT 'PTT' AS source, CAST(i AS INTEGER) AS rank, keyword, cnt
FROM range(1, 16) r(i) LEFT JOIN one ON rank = i
UNION ALL
SELECT 'none' AS source, CAST(i AS INTEGER), NULL, NULL FROM range(1, 16) r(i)""")
def top_keywords_padded(spark, sf):
    counts = keywords.valid_keywords(
        keywords.keyword_counts(_keyword_tokens(spark, sf)), src.stopwords(spark)
    )
    day = dt.date(2024, 1, 5)
    parts = [
        keywords.top_keywords_padded(counts, day, s).withColumn("source", F.lit(s))
        for s in ("PTT", "none")
    ]
    return union_sources(*parts).select("source", "rank", "keyword", "cnt")


@query(f"WITH {KEYWORDS} SELECT publish_date, source, keyword, cnt FROM counts")
def keyword_counts(spark, sf):
    return keywords.keyword_counts(_keyword_tokens(spark, sf))


@query(f"""WITH {src.TOKENS}, {src.STOP}
SELECT token, count(*) AS n FROM tokens WHERE token NOT IN (SELECT word FROM stop) GROUP BY token""")
def stopword_anti_join(spark, sf):
    tokens = _keyword_tokens(spark, sf)
    kept = keywords.drop_stopwords(tokens, src.stopwords(spark), "token")
    return kept.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {src.TOKENS}, {src.STOP} SELECT word FROM stop UNION SELECT token FROM tokens""")
def stopword_union(spark, sf):
    return keywords.union_stopwords(src.stopwords(spark), _keyword_tokens(spark, sf).select("token"))


@query(r"""WITH pieces AS (
  SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
words AS (SELECT DISTINCT word FROM pieces)
SELECT word,
       length(trim(word, chr(9) || chr(10) || chr(13) || ' ')) >= 2
       AND regexp_matches(word, '[\p{L}\p{N}]')
       AND NOT regexp_matches(trim(word, chr(9) || chr(10) || chr(13) || ' '),
                              '[\x00-\x1F\x{FEFF}\x{200B}\x{2060}]') AS valid
FROM words""")
def is_valid_keyword_query(spark, sf):
    docs = src.table(spark, sf, "documents")
    words = docs.select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return words.select("word", is_valid_keyword(F.col("word"), 2).alias("valid"))


@query(f"WITH {src.TOKENS} SELECT doc_seq, pos, token FROM tokens")
def tokenize_query(spark, sf):
    return tokenize(_emotion_docs(spark, sf), ["doc_seq"])


# Frequent endings of words rewritten in Han characters where they stand, with the blank behind them; the rest of a text stays.
HAN = (("the", "自由"), ("of", "自由自在"), ("and", "在"))
FREQUENT = (("自由", 90), ("自在", 60), ("自由自在", 2), ("在自", 40), ("由", 5), ("在", 30), ("由自", 8))


def _han_documents(spark, sf):
    text = F.col("text")
    for word, han in HAN:
        text = F.regexp_replace(text, f"(?i){word} ", han)
    return src.table(spark, sf, "documents").select(F.col("doc_id").alias("doc_seq"), text.alias("content"))


HAN_TEXT = """
d0 AS (SELECT doc_id AS doc_seq, text AS t0 FROM documents),
""" + "".join(
    f"d{i + 1} AS (SELECT doc_seq, regexp_replace(t{i}, '(?i){w} ', '{h}', 'g') AS t{i + 1} FROM d{i}),\n" for i, (w, h) in enumerate(HAN)
) + "han AS (SELECT doc_seq, lower(t3) AS content FROM d3)"
# A run of letters outside the Han block, in ranges that leave the block out.
OTHER = r"(?:[0-9A-Za-z]|[^\x00-\x7F一-鿿\PL]|[^\x00-\x7F一-鿿\PM]|[^\x00-\x7F一-鿿\PN])+"


@query(f"""WITH {HAN_TEXT},
cut AS (SELECT doc_seq, regexp_extract_all(content, '自由自在|自由|由自|[一-鿿]|{OTHER}') AS w FROM han)
SELECT doc_seq, CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS token FROM cut""")
def segment_query(spark, sf):
    words = literal_table(spark, [("自由",), ("自由自在",), ("由自",), ("The",)], ["word"])
    return segment(_han_documents(spark, sf), words, "doc_seq")


@query(f"""WITH RECURSIVE {HAN_TEXT},
pieces AS (SELECT doc_seq, regexp_extract_all(content, '[一-鿿]+|{OTHER}') AS w FROM han),
runs AS (SELECT doc_seq, CAST(unnest(range(len(w))) AS INTEGER) AS run, unnest(w) AS piece FROM pieces),
lex AS (SELECT word, CAST(freq AS DOUBLE) AS freq FROM {src.values(FREQUENT, "word, freq")}),
rated AS (SELECT list({{'w': word, 'n': length(word), 'p': CAST(round((ln(freq) - ln((SELECT sum(freq) FROM lex))) * 1e9) AS BIGINT)}}) AS words,
                 CAST(round(-ln(sum(freq)) * 1e9) AS BIGINT) AS floor FROM lex),
kinds AS (SELECT DISTINCT piece FROM runs WHERE regexp_matches(piece, '^[一-鿿]')),
graph AS (
  SELECT piece, length(piece) AS i, [0::BIGINT] AS best, []::BIGINT[] AS take FROM kinds
  UNION ALL
  SELECT piece, i - 1, list_prepend(top.p, best), list_prepend(top.n, take) FROM (
    SELECT g.*, list_max(list_concat(
      CASE WHEN len([x FOR x IN words IF x.w = substr(piece, i, 1)]) = 0 THEN [{{'p': floor + best[1], 'n': 1::BIGINT}}] ELSE [] END,
      [{{'p': x.p + best[x.n], 'n': x.n}} FOR x IN words IF substr(piece, i, x.n) = x.w])) AS top
    FROM graph g, rated WHERE i > 0)),
found AS (SELECT piece, take FROM graph WHERE i = 0),
walk AS (
  SELECT piece, take, 1::BIGINT AS spot, 0 AS k, NULL::VARCHAR AS token FROM found
  UNION ALL
  SELECT piece, take, spot + take[spot], k + 1, substr(piece, spot, take[spot]) FROM walk WHERE spot <= len(take)),
parts AS (
  SELECT doc_seq, run, k, token FROM runs JOIN walk USING (piece) WHERE k > 0
  UNION ALL SELECT doc_seq, run, 1, piece FROM runs WHERE NOT regexp_matches(piece, '^[一-鿿]'))
SELECT doc_seq, CAST(row_number() OVER (PARTITION BY doc_seq ORDER BY run, k) - 1 AS INTEGER) AS pos, token FROM parts""")
def segment_word_graph(spark, sf):
    words = literal_table(spark, FREQUENT, ["word", "freq"])
    return segment_probable(_han_documents(spark, sf), words, "doc_seq")


LEXED = src.TOKENS + f", {src.LEX}, {src.POL}, hits AS (SELECT t.*, category FROM tokens t JOIN lex ON token = word)"


@query(f"WITH {LEXED} SELECT doc_seq, pos, token, category FROM hits")
def lexicon_join(spark, sf):
    hits = emotion.with_category(_emotion_tokens(spark, sf), src.lexicon(spark))
    return hits.select("doc_seq", "pos", "token", "category")


@query(f"""WITH {LEXED}
SELECT category, polarity, count(*) AS n, CAST(sum(polarity) AS BIGINT) AS total
FROM hits JOIN pol USING (category) GROUP BY ALL""")
def polarity_join(spark, sf):
    hits = emotion.with_category(_emotion_tokens(spark, sf), src.lexicon(spark))
    rated = emotion.with_polarity(hits, emotion.polarity_table(spark))
    return rated.groupBy("category", "polarity").agg(
        F.count(F.lit(1)).alias("n"), F.sum("polarity").alias("total")
    )


@query(f"WITH {LEXED} SELECT doc_seq, token AS word, count(*) AS cnt FROM hits GROUP BY ALL")
def emotion_word_counts(spark, sf):
    counts = emotion.word_counts(_emotion_tokens(spark, sf), src.lexicon(spark), ["doc_seq"])
    return counts.select("doc_seq", "word", "cnt")


CATEGORIES = LEXED + """,
cats AS (SELECT doc_seq, category, count(*) AS cnt, min(pos) AS first_pos FROM hits GROUP BY ALL),
best AS (
  SELECT doc_seq, category AS dominant_emotion FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_seq ORDER BY cnt DESC, first_pos) AS r FROM cats) WHERE r = 1),
scores AS (SELECT doc_seq, CAST(sum(cnt * polarity) AS BIGINT) AS s FROM cats JOIN pol USING (category) GROUP BY doc_seq)
"""


@query(f"WITH {CATEGORIES} SELECT doc_seq, category, cnt, first_pos FROM cats")
def emotion_category_counts(spark, sf):
    return emotion.category_counts(_emotion_tokens(spark, sf), src.lexicon(spark), ["doc_seq"])


def _all_tokens(spark, sf, carry):
    return tokenize(_emotion_docs(spark, sf), carry, keep_empty=True)


def _doc_emotions(spark, sf):
    doc = ["doc_seq", "publish_date", "source"]
    return emotion.emotions_per_document(
        _all_tokens(spark, sf, doc), src.lexicon(spark), emotion.polarity_table(spark), doc
    )


@query(f"""WITH {CATEGORIES}
SELECT a.doc_seq, publish_date, source, coalesce(s, 0) AS emotion_score
FROM articles a LEFT JOIN scores USING (doc_seq)""")
def emotion_score(spark, sf):
    return _doc_emotions(spark, sf).drop("dominant_emotion")


@query(f"""WITH {CATEGORIES}
SELECT a.doc_seq, publish_date, source, dominant_emotion
FROM articles a LEFT JOIN best USING (doc_seq)""")
def dominant_emotion(spark, sf):
    return _doc_emotions(spark, sf).drop("emotion_score")


RANKED = CATEGORIES + """,
word_counts AS (SELECT doc_seq, publish_date, source, token AS word, count(*) AS cnt FROM hits GROUP BY ALL),
ranked AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_seq ORDER BY cnt DESC, word) AS rank FROM word_counts)
  WHERE rank <= 15)
"""


@query(f"WITH {RANKED} SELECT doc_seq, CAST(rank AS INTEGER) AS rank, word, cnt FROM ranked")
def doc_emotion_top15(spark, sf):
    counts = emotion.word_counts(_emotion_tokens(spark, sf), src.lexicon(spark), ["doc_seq"])
    return emotion.doc_top_words(counts, ["doc_seq"]).select("doc_seq", "rank", "word", "cnt")


@query(f"""WITH {RANKED},
taken AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY publish_date, source, rank ORDER BY doc_seq) AS first FROM ranked)
  WHERE first = 1)
SELECT publish_date, source, CAST(rank AS INTEGER) AS rank, word AS emotion_word, cnt, dominant_emotion,
       s AS emotion_score
FROM taken JOIN best USING (doc_seq) JOIN scores USING (doc_seq)""")
def daily_emotions(spark, sf):
    return daily.daily_emotions(
        src.raw_documents(spark, sf), src.lexicon(spark), emotion.polarity_table(spark)
    )


@query(f"""WITH {LEXED},
words AS (SELECT publish_date, source, token AS word, count(*) AS cnt FROM hits GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY publish_date, source ORDER BY cnt DESC, word) AS rank FROM words),
cats AS (
  SELECT publish_date, source, category, polarity, count(*) AS n
  FROM hits JOIN pol USING (category) GROUP BY ALL),
best AS (
  SELECT publish_date, source, category AS dominant_emotion FROM (
    SELECT *, row_number() OVER (PARTITION BY publish_date, source ORDER BY n DESC, category) AS r FROM cats)
  WHERE r = 1),
scores AS (SELECT publish_date, source, CAST(sum(n * polarity) AS BIGINT) AS emotion_score FROM cats GROUP BY ALL)
SELECT publish_date, source, CAST(rank AS INTEGER) AS rank, word AS emotion_word, cnt, dominant_emotion, emotion_score
FROM ranked JOIN best USING (publish_date, source) JOIN scores USING (publish_date, source)
WHERE rank <= 15""")
def daily_emotions_sum(spark, sf):
    return daily.daily_emotions(
        src.raw_documents(spark, sf), src.lexicon(spark), emotion.polarity_table(spark), mode="sum"
    )


@query(f"""WITH {LEXED},
rated AS (
  SELECT doc_seq, count(*) FILTER (polarity > 0) AS p, count(*) FILTER (polarity < 0) AS n
  FROM hits JOIN pol USING (category) GROUP BY doc_seq)
SELECT a.doc_seq, CASE WHEN p + n > 0 THEN CAST(p AS DOUBLE) / (p + n) END AS score
FROM articles a LEFT JOIN rated USING (doc_seq)""")
def sentiment_score(spark, sf):
    return emotion.sentiment_per_document(
        _all_tokens(spark, sf, ["doc_seq"]), src.lexicon(spark), emotion.polarity_table(spark), ["doc_seq"]
    )


@query(f"""WITH {src.TOKENS} SELECT doc_seq, token AS word, count(*) AS n FROM tokens GROUP BY ALL""")
def word_frequency_map_query(spark, sf):
    docs = ann.annotate_words(_emotion_docs(spark, sf), ["doc_seq"], lower=True)
    maps = word_frequency_map(docs, "doc_seq")
    return maps.select("doc_seq", F.explode("word_frequency").alias("word", "n"))


# Case is kept here, as a model would see it.
CASED = src.ARTICLES + r""",
split AS MATERIALIZED (
  SELECT doc_seq, url, publish_date, regexp_extract_all(content, '[\p{L}\p{M}\p{N}]+') AS w FROM articles),
cased AS MATERIALIZED (
  SELECT doc_seq, url, publish_date, unnest(w) AS word, CAST(unnest(range(len(w))) AS INTEGER) AS pos_idx FROM split),
tagged AS MATERIALIZED (
  SELECT *, CASE WHEN regexp_matches(word, '^\p{N}+$') THEN 'Neu' ELSE 'FW' END AS pos FROM cased)
"""


def _annotated(spark, sf):
    return ann.annotate_words(_emotion_docs(spark, sf), ["url", "publish_date"])


@query(f"""WITH {CASED}
SELECT url, pos_idx, word, pos, count(*) OVER (PARTITION BY url, word) AS frequency FROM tagged""")
def word_pos_frequency(spark, sf):
    return ann.word_pos_frequency(_annotated(spark, sf))


@query(f"""WITH {CASED} SELECT url, string_agg(word || '(' || pos || ')', '　' ORDER BY pos_idx) AS packed
FROM tagged GROUP BY url""")
def pack_word_pos_query(spark, sf):
    packed = _annotated(spark, sf).select(
        "url", pack_word_pos(F.col("words"), F.col("pos")).alias("packed")
    )
    # A filter would be moved below and pack every text twice.
    return packed.select("url", F.explode(F.filter(F.array("packed"), lambda p: p != "")).alias("packed"))


@query(f"""WITH {CASED} SELECT url, word, pos, count(*) AS n FROM tagged WHERE pos <> 'Neu' GROUP BY ALL""")
def pos_filter(spark, sf):
    kept = ann.pos_filter(_annotated(spark, sf), ["Neu"])
    pairs = kept.select("url", F.explode(F.arrays_zip("words", "pos")).alias("p"))
    return pairs.groupBy("url", F.col("p.words").alias("word"), F.col("p.pos").alias("pos")).agg(
        F.count(F.lit(1)).alias("n")
    )


# Every match, the longest one of each start, and from it to the first start behind its end.
@query(f"""WITH RECURSIVE {src.TOKENS},
gaz AS (SELECT regexp_replace(word, ' +', ' ', 'g') AS word, type FROM {src.values(src.NAMES, 'word, type')}),
ahead AS MATERIALIZED (
  SELECT doc_seq, pos, token AS w1, token || ' ' || lead(token, 1) OVER d AS w2,
         token || ' ' || lead(token, 1) OVER d || ' ' || lead(token, 2) OVER d AS w3
  FROM tokens WINDOW d AS (PARTITION BY doc_seq ORDER BY pos)),
longest AS MATERIALIZED (
  SELECT doc_seq, pos, CASE WHEN w3 IN (SELECT word FROM gaz) THEN w3 WHEN w2 IN (SELECT word FROM gaz) THEN w2 ELSE w1 END AS entity
  FROM ahead WHERE w1 IN (SELECT word FROM gaz) OR w2 IN (SELECT word FROM gaz) OR w3 IN (SELECT word FROM gaz)),
span AS (SELECT *, pos + len(string_split(entity, ' ')) AS past FROM longest),
step AS MATERIALIZED (
  SELECT a.doc_seq, a.pos, a.entity, b.pos AS next FROM span a ASOF LEFT JOIN span b ON a.doc_seq = b.doc_seq AND a.past <= b.pos),
chosen AS (
  SELECT s.doc_seq, s.pos, s.entity, s.next FROM step s
  JOIN (SELECT doc_seq, min(pos) AS pos FROM step GROUP BY doc_seq) f USING (doc_seq, pos)
  UNION ALL SELECT s.doc_seq, s.pos, s.entity, s.next FROM chosen c JOIN step s ON s.doc_seq = c.doc_seq AND s.pos = c.next)
SELECT doc_seq, pos, entity, type FROM chosen JOIN gaz ON entity = word""")
def gazetteer_entities(spark, sf):
    docs = ann.annotate_words(_emotion_docs(spark, sf), ["doc_seq"], lower=True)
    return ann.gazetteer_entities(docs, src.names(spark), ["doc_seq"])


def _with_entities(spark, sf):
    """Annotated documents; capitalised names stand for entities."""
    return _named(_annotated(spark, sf))


def _named(annotated):
    kind = lambda w: F.when(w.rlike("^[A-D]"), "PERSON").when(F.length(w) > 6, "ORG").otherwise("GPE")
    names = F.filter("words", lambda w: w.rlike("^[A-Z]"))
    return annotated.withColumn(
        "entities", F.transform(names, lambda w: F.struct(w.alias("entity"), kind(w).alias("type")))
    )


ENTITIES = CASED + r""",
names AS MATERIALIZED (
  SELECT url, publish_date, word AS entity,
         CASE WHEN regexp_matches(word, '^[A-D]') THEN 'PERSON' WHEN length(word) > 6 THEN 'ORG' ELSE 'GPE' END AS type,
         row_number() OVER (PARTITION BY url ORDER BY pos_idx) - 1 AS idx
  FROM cased WHERE regexp_matches(word, '^[A-Z]'))
"""


@query(f"""WITH {ENTITIES}
SELECT url, CAST(idx AS INTEGER) AS idx, entity, type,
       count(*) OVER (PARTITION BY url, entity) AS counts, publish_date FROM names""")
def entity_mentions(spark, sf):
    return ann.entity_mentions(_with_entities(spark, sf))


@query(f"""WITH {ENTITIES},
wn AS MATERIALIZED (SELECT url, word, count(*) AS frequency FROM tagged GROUP BY ALL),
en AS MATERIALIZED (SELECT url, entity, count(*) AS n FROM names GROUP BY ALL),
i AS (SELECT DISTINCT url, publish_date, author FROM articles WHERE url IN (SELECT url FROM wn))
SELECT 'article_info' AS name, url, CAST(publish_date AS VARCHAR) AS a, author AS b, CAST(NULL AS BIGINT) AS n FROM i
UNION ALL SELECT 'word_pos_frequency', url, word, pos, frequency FROM tagged JOIN wn USING (url, word)
UNION ALL SELECT 'named_entities', url, entity, type, n FROM names JOIN en USING (url, entity)""")
def normalize_annotated(spark, sf):
    annotated = ann.annotate_words(_emotion_docs(spark, sf), ["url", "publish_date", "title", "author", "content"])
    docs = ann.annotated_content(_named(annotated), None, "ptt")
    # Stored once, as jobs do, for the three tables.
    path = scratch(spark, "annotated")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    t = ann.normalize_annotated(docs)
    none = F.lit(None).cast("bigint")
    return (
        t["article_info"]
        .select(
            F.lit("article_info").alias("name"), "url",
            F.col("publish_date").cast("string").alias("a"), F.col("author").alias("b"), none.alias("n"),
        )
        .union(
            t["word_pos_frequency"].select(F.lit("word_pos_frequency"), "url", "word", "pos", "frequency")
        )
        .union(t["named_entities"].select(F.lit("named_entities"), "url", "entity", "type", "count"))
    )


@query(f"""WITH {src.ARTICLES},
split AS (SELECT url, string_split({CLEAN}, ' ') AS w FROM articles),
t AS (SELECT url, unnest(w) AS word, unnest(range(len(w))) AS i FROM split),
n AS (SELECT url, word, row_number() OVER (PARTITION BY url ORDER BY i) - 1 AS place FROM t WHERE word <> ''),
k AS (SELECT *, regexp_matches(word, '^[A-Z]') AS name FROM n)
SELECT url, 'word' AS kind, place, word, CASE WHEN name THEN 'FW' ELSE 'Na' END AS tag FROM k
UNION ALL SELECT url, 'entity', row_number() OVER (PARTITION BY url ORDER BY place) - 1, word, 'PERSON' FROM k WHERE name""")
def annotate(spark, sf):
    # A rule stands for a model. Defined here, it travels to the workers by value.
    def factory():
        def one(text):
            words = [w for w in text.split(" ") if w]
            named = ["A" <= w[0] <= "Z" for w in words]
            tags = ["FW" if n else "Na" for n in named]
            return words, tags, [(w, "PERSON") for w, n in zip(words, named, strict=True) if n]

        return lambda texts: [one(t) for t in texts]

    out = ann.annotate(_emotion_docs(spark, sf), factory)
    # One run of the model for both kinds of rows.
    word = lambda x, i: F.struct(F.lit("word").alias("kind"), i.alias("place"), x["words"].alias("word"), x["pos"].alias("tag"))
    name = lambda x, i: F.struct(F.lit("entity").alias("kind"), i.alias("place"), x["entity"].alias("word"), x["type"].alias("tag"))
    items = F.concat(F.transform(F.arrays_zip("words", "pos"), word), F.transform("entities", name))
    return out.select("url", F.explode(items).alias("x")).select("url", "x.kind", F.col("x.place").cast("bigint").alias("place"), "x.word", "x.tag")


# SQL can't train a model; tests hold the predictions against the labels.
@query()
def sentiment_classifier(spark, sf):
    """Every document with its predicted class and confidence; the model learns from labels of documents not held out."""
    docs = src.table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    labels = src.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    held_out = F.col("doc_id") % 5 == 0
    model = sentiment.train_sentiment(docs.join(labels.filter("label is not null"), "doc_id").filter(~held_out))
    return sentiment.apply_sentiment(model, docs).select("doc_id", "predicted", "confidence", held_out.alias("held_out"))
