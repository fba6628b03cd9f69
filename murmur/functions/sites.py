"""URL, by-line, rubric and comment-stamp expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.bind import once
from murmur.functions.fixed import (
    KEYWORD_SOURCES,
    OTHER_SOURCE,
    SOURCE_OF_EMPTY_URL,
    UNCATEGORISED,
    UNKNOWN,
)
from murmur.functions.text import strip

# Fixed by-line patterns.
REPORTER_SLASH = r"記者([一-龥]{2,4})／"
REPORTER_OR_EDITOR = r"(?:記者|編譯)([一-龥]{2,3})"
REPORTER_BYLINES = (
    r"記者\s*([^\s／]+)",
    r"撰文\s*([^\s／]+)",
    r"文\s*：\s*([^\s／]+)CTWANT ",
)
COMMENT_STAMP = r"^([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+) ([^\n]+)"


def classify_source(
    url: Column,
    rules: Sequence[tuple[str, str]] = KEYWORD_SOURCES,
    empty: str = SOURCE_OF_EMPTY_URL,
    default: str = OTHER_SOURCE,
) -> Column:
    """Name of the first rule whose text occurs in the URL, case ignored."""

    def rule(low: Column) -> Column:
        out = F.when(low.isNull() | (low == ""), F.lit(empty))
        for part, name in rules:
            out = out.when(low.contains(part), F.lit(name))
        return out.otherwise(F.lit(default))

    return once(F.lower(url), rule)


def first_match(c: Column, patterns: Sequence[str], default: str | None = None) -> Column:
    """First group of the first pattern that finds something."""
    found = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*found, F.lit(default))


def reporter_between(c: Column) -> Column:
    """Text between the first reporter mark and the first wide slash, else empty."""

    def rule(t: Column) -> Column:
        start, end = F.instr(t, "記者"), F.instr(t, "／")
        name = F.substring(t, start + 2, end - start - 2)
        kept = strip(F.regexp_replace(name, r"(?U)[^\p{L}\p{N}\s]", ""))
        return F.when((start > 0) & (end > start + 2), kept).otherwise(F.lit(""))

    return once(strip(c), rule)


def reporter_slash(c: Column) -> Column:
    return first_match(c, [REPORTER_SLASH], UNKNOWN)


def reporter_or_editor(c: Column) -> Column:
    return first_match(c, [REPORTER_OR_EDITOR], UNKNOWN)


def reporter_byline(c: Column) -> Column:
    return first_match(c, REPORTER_BYLINES)


def url_absolute(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def article_id(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def category_path(crumbs: Column, default: str = UNCATEGORISED) -> Column:
    """Last two breadcrumbs as ``a/b``; a shorter trail gives the default."""
    return once(
        crumbs,
        lambda c: F.when(F.size(c) >= 2, F.array_join(F.slice(c, -2, 2), "/")).otherwise(F.lit(default)),
    )


def comment_prefix_strip(c: Column) -> Column:
    """Drop the two characters that introduce a comment body."""
    return F.substring(c, 3, 2**31 - 1)


def comment_time_ip(c: Column, default: Column, year: int = 2024) -> Column:
    """``ip rest`` as struct(ip, date); a rest that is no ``M/D`` is kept as text."""
    ip = F.nullif(F.regexp_extract(c, COMMENT_STAMP, 1), F.lit(""))
    rest = F.regexp_extract(c, COMMENT_STAMP, 2)
    day = F.try_to_date(F.concat(F.lit(f"{year}/"), rest), "yyyy/M/d")
    date = F.when(
        ip.isNotNull(), F.coalesce(F.date_format(day, "yyyy-MM-dd"), rest)
    ).otherwise(default.cast("string"))
    return F.struct(ip.alias("ip"), date.alias("date"))
