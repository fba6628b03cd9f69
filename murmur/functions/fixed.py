"""They must be exactly these for results to come out right."""

# Characters that count as blank when a text is stripped.
BLANKS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)

# Names given to articles by a substring of their URL; the first hit wins.
KEYWORD_SOURCES = (
    ("ptt", "PTT"),
    ("dcard", "Dcard"),
    ("ettoday", "ETtoday"),
    ("yahoo", "Yahoo"),
    ("setn", "三立新聞網"),
    ("udn", "聯合新聞網"),
    ("ltn", "自由時報"),
)
EMOTION_SOURCES = (
    ("ptt.cc", "PTT"),
    ("dcard.tw", "Dcard"),
    ("ettoday", "ETtoday"),
    ("yahoo", "Yahoo"),
    ("setn", "三立新聞網"),
    ("udn", "聯合新聞網"),
    ("ltn", "自由時報"),
)
SOURCE_OF_EMPTY_URL = "ETtoday"
OTHER_SOURCE = "其他新聞網"

# Emotion category -> polarity.
POLARITY = (
    ("喜悅", 1),
    ("安心", 1),
    ("期待", 1),
    ("正面", 1),
    ("支持", 1),
    ("成功", 1),
    ("謝謝", 1),
    ("優惠", 1),
    ("有趣", 1),
    ("願意", 1),
    ("驚訝", 0),
    ("生氣", -1),
    ("討厭", -1),
    ("難過", -1),
    ("焦慮", -1),
    ("反感", -1),
    ("失望", -1),
    ("違規", -1),
    ("貶低", -1),
    ("憤怒", -1),
    ("厭惡", -1),
    ("質疑", -1),
    ("諷刺", -1),
    ("不滿", -1),
    ("擔憂", -1),
    ("後悔", -1),
    ("麻煩", -1),
)

# Push tags that are counted by name; every other tag counts as an arrow.
PUSH_TAG = "推"
BOO_TAG = "噓"

UNKNOWN = "未知"
UNCATEGORISED = "未分類"
