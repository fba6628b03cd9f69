"""Canonical schemas as DDL. Field names of both vocabularies are fixed values."""

MESSAGE = (
    "topic string, partition int, offset bigint, key string, value string, timestamp timestamp"
)

PTT_COMMENT_ZH = "struct<`推文`: string, `用戶`: string, `內容`: string, `時間`: string>"
PTT_COMMENT_EN = "struct<push: string, user: string, comment: string, time: string>"
DCARD_COMMENT_ZH = "struct<`用戶`: string, `內容`: string, `時間`: string>"
DCARD_COMMENT_EN = "struct<user: string, comment: string, time: string>"

PTT_ZH = (
    "`發佈日期` string, `標題` string, `作者` string, `內容` string, `推` bigint, `噓` bigint, "
    f"`箭頭` bigint, `連結` string, `留言` array<{PTT_COMMENT_ZH}>"
)
PTT_EN = (
    "date string, title string, author string, post string, good bigint, bad bigint, "
    f"arrow bigint, url string, comment_num array<{PTT_COMMENT_EN}>"
)
DCARD_ZH = (
    "`文章ID` string, `作者` string, `標題` string, `連結` string, `發布時間` string, "
    "`內容` string, `總emoji數` string, `emoji類型` array<map<string,string>>, "
    f"`留言` array<map<string,{DCARD_COMMENT_ZH}>>, hash_tag array<string>, `看版` string"
)
DCARD_EN = (
    "article_ID string, author string, title string, url string, date string, post string, "
    "emoji_num string, emoji_type array<map<string,string>>, "
    f"comment_num array<map<string,{DCARD_COMMENT_EN}>>, hash_tag array<string>, type string"
)
NEWS = (
    "title string, url string, reporter string, author string, content string, date string, "
    "category string, news_category string, crawl_time string, likes bigint"
)

# Every text field an article can carry, in either vocabulary.
ARTICLE_FIELDS = (
    "標題",
    "title",
    "作者",
    "author",
    "reporter",
    "內容",
    "content",
    "post",
    "發佈日期",
    "date",
    "發布時間",
    "publish_date",
    "連結",
    "url",
    "category",
    "news_category",
)
ARTICLE = ", ".join(f"`{name}` string" for name in ARTICLE_FIELDS)

COMMENT = (
    "url string, pos bigint, comment_id string, tag string, user string, content string, time string"
)

FRONTIER = (
    "id string, date date, url string, first_crawl int, confirm_num bigint, last_update date"
)

ANNOTATION = (
    "url string, words array<string>, pos array<string>, "
    "entities array<struct<entity: string, type: string>>"
)
