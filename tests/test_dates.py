import datetime as dt

from pyspark.sql import functions as F

from murmur.functions import dates

AS_OF = dt.date(2024, 3, 5)


def test_date_keyword(column):
    raw = ["2024-01-02", "2023-10-24T08:00:00Z", "2024年1月2日", "1/2", "10/24 extra", "2024/01/02", "x", "", None, "13/45"]
    got = column(lambda c: dates.date_keyword([c], AS_OF), raw)
    # Four digits and a slash begin with no date of one or two digits.
    assert got == [
        "2024-01-02", "2023-10-24", "2024-01-02", "2024-01-02", "2024-10-24",
        "2024-03-05", "2024-03-05", "2024-03-05", "2024-03-05", "2024-13-45",
    ]


def test_date_keyword_takes_next_field(spark):
    row = spark.range(1).select(dates.date_keyword([F.lit("bad"), F.lit("2/3")], AS_OF)).first()
    assert row[0] == "2024-02-03"


def test_date_emotion(column):
    raw = ["2024年1月2日", "於2024年11月2日報導", "年月日", "1/2", " 1 / 2 ", "a/b", "1/2/3", "2024-01-02T10:00:00Z",
           "2024-01-02 10:00", "2024-01-02", "Tomorrow", "x", "", None, "13/45", "123/4"]
    assert column(dates.date_emotion, raw) == [
        "2024-01-02", "2024-11-02", None, "2024-01-02", "2024-01-02", None, None, "2024-01-02",
        "2024-01-02 10:00", "2024-01-02", "", None, None, None, "2024-13-45", "2024-123-04",
    ]


def test_date_annotation(column):
    raw = ["2023/10/24", "2024/1/2", "10/24", "2/30", "2024-01-02", "未知日期", None, "2/29"]
    day = dt.date
    assert column(dates.date_annotation, raw) == [
        day(2024, 10, 24), day(2024, 1, 2), day(2024, 10, 24), None, None, None, None, day(2024, 2, 29),
    ]
    full = column(lambda c: dates.date_annotation(c, full_only=True), raw)
    assert full == [day(2024, 10, 24), day(2024, 1, 2), None, None, None, None, None, None]


def test_date_iso(column):
    raw = ["2024-01-02T23:30:00.000Z", "2024-01-02T23:30:00.123456Z", "2024-01-02T23:30:00Z", "2024-01-02", "2024-01-02T25:30:00.000Z", "", None]
    day = dt.date(2024, 1, 2)
    assert column(dates.date_iso, raw) == [day, day, None, None, None, None, None]
    assert column(lambda c: dates.date_iso(c, 8), raw[:1]) == [dt.date(2024, 1, 3)]


def test_date_rollback_year(column):
    got = column(lambda c: dates.date_rollback_year(c, dt.date(2025, 3, 1)), ["1/2", "2/29", "2/30", "x", None])
    assert got == ["2025/01/02", "2024/02/29", None, None, None]


def test_date_news(column):
    raw = ["2024/10/24 08:30:00", "2024-10-24 08:30", "2024-10-24", "x", None]
    assert column(dates.date_news, raw) == ["2024-10-24", "2024-10-24", "未知", "未知", "未知"]


def test_date_news_iso_keeps_its_own_clock(column):
    raw = ["2024-10-24T08:30:00Z", "2024-10-24T08:30:00+08:00", "yesterday", None]
    assert column(dates.date_news_iso, raw) == ["2024-10-24 08:30:00", "2024-10-24 08:30:00", "yesterday", None]


def test_text_day(column):
    assert column(dates.text_day, ["2024-01-02 10:00", "2024-13-45", None]) == [dt.date(2024, 1, 2), None, None]
