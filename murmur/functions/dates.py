"""Date rules of the jobs. The clock is always a parameter, so results repeat."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.bind import once
from murmur.functions.fixed import UNKNOWN

# Fixed formats.
ISO_DAY = r"^([0-9]{4})-([0-9]{2})-([0-9]{2})"
HAN_DAY = r"([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日"
SLASH_DAY = r"^([0-9]{1,2})/([0-9]{1,2})"
ISO_INSTANT = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\.[0-9]{1,9}Z$"
)


def _two(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _ymd(c: Column, pattern: str) -> Column:
    y, m, d = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))
    return F.concat_ws("-", y, _two(m), _two(d))


def _keyword_day(c: Column, year: int) -> Column:
    month, day = (F.regexp_extract(c, SLASH_DAY, i) for i in (1, 2))
    return (
        F.when(c.rlike(ISO_DAY), _ymd(c, ISO_DAY))
        .when(c.rlike("^" + HAN_DAY), _ymd(c, "^" + HAN_DAY))
        .when(c.rlike(SLASH_DAY), F.concat_ws("-", F.lit(str(year)), _two(month), _two(day)))
    )


def date_keyword(fields: Sequence[Column], as_of: dt.date) -> Column:
    """First field with a readable day as ``YYYY-MM-DD``, else the day ``as_of``.

    Month and day are not range-checked.
    """
    found = F.transform(F.array(*fields), lambda v: _keyword_day(v, as_of.year))
    first = F.get(F.filter(found, lambda day: day.isNotNull()), F.lit(0))
    return F.coalesce(first, F.lit(as_of.isoformat()))


def _int(c: Column) -> Column:
    return F.btrim(c).try_cast("bigint")


def date_emotion(c: Column, year: int = 2024) -> Column:
    """Day text by the first rule that applies, null when that rule fails.

    A text that starts with ``YYYY-MM-DD`` comes back unchanged, clock included.
    """

    def rule(v: Column) -> Column:
        parts = F.split(v, "/")
        month, day = _int(F.get(parts, 0)), _int(F.get(parts, 1))
        return (
            F.when(v.isNull() | (v == ""), None)
            .when(
                v.contains("年") & v.contains("月") & v.contains("日"),
                F.when(v.rlike(HAN_DAY), _ymd(v, HAN_DAY)),
            )
            .when(
                F.size(parts) == 2,
                F.when(
                    month.isNotNull() & day.isNotNull(),
                    F.format_string("%d-%02d-%02d", F.lit(year), month, day),
                ),
            )
            .when(v.contains("T"), F.substring_index(v, "T", 1))
            .when(v.rlike(ISO_DAY), v)
        )

    return once(c, rule)


def date_annotation(c: Column, year: int = 2024, full_only: bool = False) -> Column:
    """``Y/M/D`` or ``M/D`` to a date, 2023 read as 2024; null if not a day.

    ``full_only`` accepts only the form with a year.
    """

    def rule(v: Column) -> Column:
        n = F.size(F.split(v, "/"))
        full = F.when(n == 3, F.try_to_date(v, "yyyy/M/d"))
        if full_only:
            return full
        short = F.when(n == 2, F.try_to_date(F.concat(F.lit(f"{year}/"), v), "yyyy/M/d"))
        return F.coalesce(full, short)

    return once(F.replace(c, F.lit("2023"), F.lit("2024")), rule)


def date_iso(c: Column, shift_hours: int = 0) -> Column:
    """Day of an instant ``YYYY-MM-DDThh:mm:ss.fZ`` in UTC, or shifted; else null."""
    at = F.when(c.rlike(ISO_INSTANT), c.try_cast("timestamp_ntz"))
    if shift_hours:
        at = at + F.make_dt_interval(hours=F.lit(shift_hours))
    return at.cast("date")


def date_rollback_year(c: Column, as_of: dt.date) -> Column:
    """``M/D`` in the current year, or in the year before if it is no day there."""

    def of(year: int) -> Column:
        return F.try_to_date(F.concat(F.lit(f"{year}/"), c), "yyyy/M/d")

    return F.date_format(F.coalesce(of(as_of.year), of(as_of.year - 1)), "yyyy/MM/dd")


def date_news(c: Column) -> Column:
    """Site clock text to ``YYYY-MM-DD``, else the marker for unknown."""
    at = F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy/M/d H:m:s")),
        F.try_to_timestamp(c, F.lit("yyyy-M-d H:m")),
    )
    return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(UNKNOWN))


def date_news_iso(c: Column) -> Column:
    """ISO instant to ``YYYY-MM-DD hh:mm:ss`` on its own clock, else unchanged."""
    at = F.when(c.rlike(ISO_DAY), c.try_cast("timestamp_ntz"))
    return F.coalesce(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), c)


def text_day(c: Column) -> Column:
    """Date of a text that begins with ``YYYY-MM-DD``; null when out of range."""
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
