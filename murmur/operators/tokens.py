"""Documents to tokens and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.bind import once
from murmur.functions.text import HAN, WORD, tokens
from murmur.operators.joins import literal_table, small_lookup
from murmur.operators.layout import by_document


def tokenize(
    docs: DataFrame,
    carry: Sequence[str],
    content: str = "content",
    words: Sequence[str] = (),
    lower: bool = True,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per token: the carried columns, ``pos`` and ``token``.

    Rows stream out of each document, which itself stays in its partition.
    ``keep_empty`` gives a document without tokens one row without a token.
    """
    found = tokens(F.col(content), words, lower)
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return docs.select(*carry, explode(found).alias("pos", "token"))


def token_rows(docs: DataFrame, carry: Sequence[str], words: str = "words") -> DataFrame:
    """As ``tokenize``, for documents whose words are already an array column.

    Exploded with nulls for empty arrays, which are dropped after: otherwise
    Catalyst tests the size of the array first, and builds it twice for that.
    """
    rows = docs.select(*carry, F.posexplode_outer(words).alias("pos", "token"))
    return rows.filter("pos is not null")


# Words of a run of Han characters: where they begin, from 1, and their length; other characters are tokens of their own.
CUTS = "array<struct<at: int, n: int>>"


def _pieces(content: str, lower: bool) -> Column:
    """Runs of Han characters and words of other scripts, in order."""
    text = F.lower(content) if lower else F.col(content)
    return F.regexp_extract_all(text, F.lit(f"[{HAN}]+|{WORD}"), F.lit(0))


def _han_runs(docs: DataFrame, doc: str, content: str, lower: bool) -> DataFrame:
    """(doc, run, chars): runs of two Han characters or more, as their characters; no other piece of a text becomes a row."""
    runs = docs.select(doc, F.posexplode(_pieces(content, lower)).alias("run", "piece"))
    # A run is held as its characters, so that cutting one out takes no scan.
    long = runs.filter(F.col("piece").rlike(f"^[{HAN}]{{2}}"))
    return long.select(doc, "run", F.regexp_extract_all("piece", F.lit("."), F.lit(0)).alias("chars"))


def _spelled(docs: DataFrame, paths: DataFrame, doc: str, content: str, lower: bool, carry: Sequence[str]) -> DataFrame:
    """Tokens of whole documents with the words found in their runs, (doc, run, cuts).

    The words of a document meet it in one row; its other pieces are read from its text again, not carried as rows.
    """
    by_doc = paths.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("run", "cuts"))).alias("_paths"))
    none = F.lit(None).cast(CUTS)

    def filled(path, i):
        """The path behind as many nulls as there are pieces since the one before, so that its place is its run's."""
        before = F.coalesce(F.get("_paths", i - 1)["run"], F.lit(-1))
        return F.concat(F.array_repeat(none, path["run"] - before - 1), F.array(path["cuts"]))

    def spelled(chars, cuts):
        # With the ends of the run put around them, the words bound a stretch of single
        # characters, a word, a stretch of single characters, and so on.
        ends = F.flatten(F.transform(cuts, lambda c: F.array(c["at"], c["at"] + c["n"])))
        bounds = F.concat(F.array(F.lit(1)), F.coalesce(ends, F.array().cast("array<int>")), F.array(F.size(chars) + 1))

        def parts(b):
            def part(i):
                begin, end = F.get(b, i), F.get(b, i + 1)
                cut = F.slice(chars, begin, end - begin)
                return F.when(i % 2 == 0, cut).otherwise(F.array(F.array_join(cut, "")))

            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(b) - 2), part))

        return once(bounds, parts)

    def piece_words(piece, cuts):
        run = once(F.regexp_extract_all(piece, F.lit("."), F.lit(0)), lambda chars: spelled(chars, cuts))
        return F.when(piece.rlike(f"^[{HAN}]{{2}}"), run).otherwise(F.array(piece))

    places = F.coalesce(F.flatten(F.transform("_paths", filled)), F.array().cast(f"array<{CUTS}>"))
    words = once(places, lambda at: F.flatten(F.transform(_pieces(content, lower), lambda p, i: piece_words(p, F.get(at, i)))))
    found = docs.join(by_doc, doc, "left").select(doc, *carry, words.alias("words"))
    return token_rows(found, [doc, *carry])


def segment(
    docs: DataFrame,
    lexicon: DataFrame,
    doc: str,
    max_len: int | None = None,
    content: str = "content",
    lower: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Tokens by longest match from the left, for a lexicon of any size.

    Each run of Han characters is cut into n-grams that are joined to the lexicon
    (``word`` column); the hits of a run, sorted, are then folded into tokens that
    do not overlap. Characters in no word are tokens of their own. ``pos`` counts
    the tokens of a document from 0, as ``tokenize`` does. Documents move once, so
    that their runs and words need no further shuffle. ``carry`` names columns that
    come along; ``max_len`` is the length of the longest word, looked up if not given.
    """
    known = lexicon.select(F.lower("word").alias("word") if lower else "word")
    known = known.filter(F.length("word") > 1).distinct()
    if max_len is None:
        max_len = known.filter(F.col("word").rlike(f"[{HAN}]")).agg(F.max(F.length("word"))).first()[0] or 1
    docs = by_document(docs.select(doc, *carry, content), doc)
    runs = _han_runs(docs, doc, content, lower)
    grams = F.transform(
        F.sequence(F.lit(1), F.size("chars")),
        lambda i: F.struct(
            i.alias("start"), F.array_join(F.slice("chars", i, max_len), "").alias("text")
        ),
    )
    candidates = (
        runs.select(doc, "run", F.explode(grams).alias("g"))
        .filter("length(g.text) > 1")
        .select(
            doc, "run", "g.start", "g.text", F.explode(F.sequence(F.lit(2), F.length("g.text"))).alias("n")
        )
        .select(doc, "run", "start", "n", F.substring("text", F.lit(1), F.col("n")).alias("word"))
    )
    hits = (
        small_lookup(candidates, known, ["word"], "left_semi")
        .groupBy(doc, "run")
        # Sorted like this, the longest of the hits at one start comes first.
        .agg(F.sort_array(F.collect_list(F.struct("start", (-F.col("n")).alias("m")))).alias("hits"))
    )

    # Begin and length of each kept word.
    def step(acc, hit):
        end = hit["start"] - hit["m"]
        word = F.struct(hit["start"].alias("at"), (-hit["m"]).alias("n"))
        return F.when(
            hit["start"] >= acc["next"],
            F.struct(end.alias("next"), F.concat(acc["kept"], F.array(word)).alias("kept")),
        ).otherwise(acc)

    none = F.array().cast(CUTS)
    cuts = F.aggregate(
        "hits",
        F.struct(F.lit(1).alias("next"), none.alias("kept")),
        step,
        lambda acc: acc["kept"],
    )
    return _spelled(docs, hits.select(doc, "run", cuts.alias("cuts")), doc, content, lower, carry)


def _billionths(c: Column) -> Column:
    return F.round(c * 1e9).cast("bigint")


def segment_probable(
    docs: DataFrame,
    lexicon: DataFrame,
    doc: str,
    content: str = "content",
    lower: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Tokens by the most probable path through the word graph, for a frequency lexicon of any size.

    ``lexicon`` has ``word`` and ``freq``; frequencies of a word given twice add up, those that aren't above 0 don't
    count. A path's probability is the product of its words' shares of all frequencies; a character that is no word
    counts as one met once. Logarithms are whole numbers of billionths, so sums are exact in any order: of equally
    probable paths the one with the longer word first wins.

    The graph of a run of Han characters has one row per character, with the words that begin there: they are looked up
    by their first two characters, one row of the lexicon per pair, so nothing is multiplied. The best path is found
    from the right end of the run, one step per character. Other runs are tokens as they are; ``pos``, ``carry`` and
    the movement of documents are as in ``segment``.
    """
    name = F.lower("word") if lower else F.col("word")
    words = lexicon.select(name.alias("word"), F.col("freq").cast("double").alias("freq")).filter(
        (F.col("freq") > 0) & F.col("word").rlike(f"^[{HAN}]+$")
    )
    words = words.groupBy("word").agg(F.sum("freq").alias("freq"))
    total, longest = words.agg(F.sum("freq"), F.max(F.length("word"))).first()
    total, longest = total or 1.0, longest or 1
    rated = words.select("word", F.length("word").alias("n"), _billionths(F.log("freq") - F.log(F.lit(total))).alias("p"))
    single = rated.filter("n = 1").select(F.col("word").alias("c"), F.col("p").alias("_p"))
    begins = rated.filter("n > 1").groupBy(F.substring("word", 1, 2).alias("two")).agg(
        F.sort_array(F.collect_list(F.struct("n", "p", "word"))).alias("_words")
    )
    docs = by_document(docs.select(doc, *carry, content), doc)
    runs = _han_runs(docs, doc, content, lower)
    places = F.transform("chars", lambda c, i: F.struct(c.alias("c"), F.array_join(F.slice("chars", i + 1, longest), "").alias("ahead")))
    at = runs.select(doc, "run", F.posexplode(places).alias("i", "x")).select(
        doc, "run", "i", "x.c", "x.ahead", F.substring("x.ahead", 1, 2).alias("two")
    )
    at = small_lookup(small_lookup(at, single, ["c"], "left"), begins, ["two"], "left")
    alone = F.struct(F.lit(1).alias("n"), F.coalesce("_p", _billionths(-F.log(F.lit(total)))).alias("p"))
    fitting = F.transform(
        F.filter("_words", lambda w: F.col("ahead").startswith(w["word"])), lambda w: F.struct(w["n"].alias("n"), w["p"].alias("p"))
    )
    edges = F.when(F.col("_words").isNull(), F.array(alone)).otherwise(F.concat(F.array(alone), fitting))
    # What the aggregate may have to sort is a place and its edges, not the words they came from.
    edged = at.select(doc, "run", F.struct("i", edges.alias("edges")).alias("place"))
    graphs = edged.groupBy(doc, "run").agg(F.sort_array(F.collect_list("place"), asc=False).alias("graph"))

    # From the right: ``best`` holds the probabilities of the paths from each place to the end, the end's first.
    def step(acc, place):
        n = F.size(acc["best"])
        paths = F.transform(place["edges"], lambda e: F.struct((e["p"] + F.element_at(acc["best"], n + 1 - e["n"])).alias("p"), e["n"].alias("n")))
        return once(
            F.array_max(paths),
            lambda top: F.struct(F.concat(acc["best"], F.array(top["p"])).alias("best"), F.concat(acc["take"], F.array(top["n"])).alias("take")),
        )

    start = F.struct(F.array(F.lit(0).cast("bigint")).alias("best"), F.array().cast("array<int>").alias("take"))
    taken = F.reverse(F.aggregate("graph", start, step, lambda acc: acc["take"]))

    # The lengths taken, followed from the left: a place is a beginning where the last word ended.
    def walk(acc, n):
        here = acc["at"] == acc["next"]
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(here, acc["at"] + n).otherwise(acc["next"]).alias("next"),
            F.when(here, F.concat(acc["cuts"], F.array(F.struct(acc["at"].alias("at"), n.alias("n"))))).otherwise(acc["cuts"]).alias("cuts"),
        )

    none = F.array().cast(CUTS)
    first = F.struct(F.lit(1).alias("at"), F.lit(1).alias("next"), none.alias("cuts"))
    cuts = F.filter(F.aggregate("taken", first, walk, lambda acc: acc["cuts"]), lambda c: c["n"] > 1)
    paths = graphs.select(doc, "run", taken.alias("taken")).select(doc, "run", cuts.alias("cuts"))
    return _spelled(docs, paths, doc, content, lower, carry)


def tokenize_with(
    docs: DataFrame,
    doc: str,
    carry: Sequence[str],
    words: DataFrame | Sequence[str] | None = None,
    lower: bool = True,
) -> DataFrame:
    """Tokens of documents; ``words`` is a lexicon of any size for Han text.

    A table with a column ``word``, or the words themselves: the longest match counts. With a column ``freq`` as
    well the most probable path does. Without any, Han text falls apart into single characters.
    """
    if words is None or (not isinstance(words, DataFrame) and not words):
        return tokenize(docs, [doc, *carry], lower=lower)
    if not isinstance(words, DataFrame):
        words = literal_table(docs.sparkSession, [(w,) for w in words], ["word"])
    cut = segment_probable if "freq" in words.columns else segment
    return cut(docs, words, doc, lower=lower, carry=carry)


def word_frequency(docs: DataFrame, doc: str, words: str = "words") -> DataFrame:
    """Occurrences of each word of a document."""
    rows = token_rows(by_document(docs.select(doc, words), doc), [doc], words)
    return rows.groupBy(doc, F.col("token").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def word_frequency_map(docs: DataFrame, doc: str, words: str = "words") -> DataFrame:
    """As ``word_frequency``, one word -> count map per document."""
    counts = word_frequency(docs, doc, words)
    return counts.groupBy(doc).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("word_frequency")
    )
