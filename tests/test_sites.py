from pyspark.sql import functions as F

from murmur.functions import sites
from murmur.functions.fixed import EMOTION_SOURCES


def test_classify_source(column):
    urls = ["https://www.PTT.cc/x", "https://ptt.example", "", None, "https://udn.com/ltn", "https://a.b"]
    assert column(sites.classify_source, urls) == ["PTT", "PTT", "ETtoday", "ETtoday", "聯合新聞網", "其他新聞網"]
    strict = column(lambda c: sites.classify_source(c, EMOTION_SOURCES), urls)
    assert strict[:2] == ["PTT", "其他新聞網"]


def test_reporters(column):
    texts = ["  記者 王小明／台北報導", "／記者王小明", "記者王小明", "記者A-B／x", None]
    assert column(sites.reporter_between, texts) == ["王小明", "", "", "AB", ""]
    lines = ["記者王小明／台北", "記者王／台北", "編譯李大同／x", "無"]
    assert column(sites.reporter_slash, lines) == ["王小明", "未知", "未知", "未知"]
    assert column(sites.reporter_or_editor, lines) == ["王小明", "未知", "李大同", "未知"]
    bylines = ["記者 王小明／x", "撰文 陳／y", "文：李CTWANT z", "文：李／z", ""]
    assert column(sites.reporter_byline, bylines) == ["王小明", "陳", "李", None, None]


def test_urls(column):
    assert column(lambda c: sites.url_absolute(c, "https://udn.com"), ["/a", "https://x/b"]) == ["https://udn.com/a", "https://x/b"]
    assert column(sites.article_id, ["https://x/f/p/123", "x"]) == ["123", "x"]


def test_category_path(column):
    got = column(sites.category_path, [["首頁", "運動", "棒球"], ["首頁"], []], "array<string>")
    assert got == ["運動/棒球", "未分類", "未分類"]


def test_comment_time_ip(column):
    raw = ["1.2.3.4 10/24", "1.2.3.4 10/24 13:45", "10/24 13:45", "", None, "1.2.3.4 2/30"]
    got = column(lambda c: sites.comment_time_ip(c, F.lit("2024-01-01")), raw)
    assert [tuple(r) for r in got] == [
        ("1.2.3.4", "2024-10-24"),
        ("1.2.3.4", "10/24 13:45"),
        (None, "2024-01-01"),
        (None, "2024-01-01"),
        (None, "2024-01-01"),
        ("1.2.3.4", "2/30"),
    ]
    assert column(sites.comment_prefix_strip, [": hi", ":"]) == ["hi", ""]
