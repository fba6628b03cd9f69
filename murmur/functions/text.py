"""Cleaning, tokenising and testing text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.fixed import BLANKS

HAN = "\u4e00-\u9fff"

# A word is a run of letters, marks and digits outside the Han block. It is one
# character class: the Java engine walks such a run in a loop, whereas a repeated
# group would recurse once per character. Letters are tested first.
WORD = rf"[\p{{L}}\p{{N}}\p{{M}}&&[^{HAN}]]+"

# Between blanks: something with a letter or digit, and no control or invisible
# character. Written over the whole word, so it need not be stripped first.
_SEEN = r"[^\x{00}-\x{1F}\x{FEFF}\x{200B}\x{2060}]*"
_EDGE = "[" + re.escape(BLANKS) + "]*"
KEYWORD = rf"^{_EDGE}{_SEEN}[\p{{L}}\p{{N}}]{_SEEN}{_EDGE}$"


def strip(c: Column) -> Column:
    """Drop leading and trailing blanks, Unicode ones included."""
    return F.btrim(c, F.lit(BLANKS))


def clean_text(c: Column) -> Column:
    """Squeeze newlines, drop mail signatures and hyphen rules, strip.

    The order matters: a signature is found only after its newlines are squeezed.
    """
    c = F.regexp_replace(c, r"\n+", "\n")
    c = F.regexp_replace(c, r"-----\nSent from[^\n]*", "")
    c = F.regexp_replace(c, r"--+", "")
    return strip(c)


def squeeze_text(paragraphs: Column) -> Column:
    """Strip each paragraph, remove its spaces and newlines, and join them all."""
    return F.array_join(
        F.transform(paragraphs, lambda p: F.regexp_replace(strip(p), "[ \n]", "")), ""
    )


def token_pattern(words: Sequence[str] = ()) -> str:
    """Regular expression whose matches are the tokens of a text.

    Han text has no blanks, so ``words`` (longest first) are tried before the
    single-character fallback. Words without Han characters are left out: they
    would cut longer words apart. For a whole dictionary a join is faster, see
    ``operators.tokens.segment``, which gives the same tokens.
    """
    han = sorted({w for w in words if re.search(f"[{HAN}]", w)}, key=lambda w: (-len(w), w))
    return "|".join([*(re.escape(w) for w in han), f"[{HAN}]", WORD])


def tokens(c: Column, words: Sequence[str] = (), lower: bool = True) -> Column:
    """Array of the tokens of a text, in order."""
    c = F.lower(c) if lower else c
    return F.regexp_extract_all(c, F.lit(token_pattern(words)), F.lit(0))


def is_valid_keyword(c: Column, min_len: int = 1) -> Column:
    """Whether a word may be reported; the test strips it, the word stays as is."""
    # Plain words are nearly all there are, and told at once.
    ok = c.rlike(r"^[\p{L}\p{N}]+$") | c.rlike(KEYWORD)
    if min_len > 1:
        ok = ok & (F.length(strip(c)) >= min_len)
    return F.coalesce(ok, F.lit(False))


def digits_to_int(c: Column) -> Column:
    """Number formed by all digits of a text, 0 without any."""
    return F.coalesce(F.regexp_replace(c, "[^0-9]", "").try_cast("bigint"), F.lit(0))


def default_string(c: Column, default: str = "") -> Column:
    return F.coalesce(c.cast("string"), F.lit(default))


def first_non_empty(*cols: Column) -> Column:
    """The first column that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols))


def pack_word_pos(words: Column, pos: Column) -> Column:
    """Render ``word(pos)`` pairs; words and tags must pair up."""
    packed = F.array_join(
        F.zip_with(words, pos, lambda w, p: F.concat(w, F.lit("("), p, F.lit(")"))), "\u3000"
    )
    return F.when(F.size(words) == F.size(pos), packed).otherwise(
        F.raise_error(F.lit("words and parts of speech differ in number"))
    )


def signed_score(label: Column, score: Column) -> Column:
    """Model confidence with the sign of its label."""
    return F.when(label == "positive", score).otherwise(-score)


def hashtags(c: Column) -> Column:
    """Newline-separated text as an array; no element gives an empty array."""
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.split(c, "\n"))
