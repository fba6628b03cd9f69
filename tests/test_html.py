from pyspark.sql import functions as F

from murmur.functions import html
from murmur.operators.articles import extract_articles


def read(spark, page, rules):
    pages = spark.createDataFrame([(1, "https://x/1", page)], "page_id bigint, url string, html string")
    return extract_articles(pages, rules).first().asDict()


def test_unescape(column):
    raw = ["a &amp;lt; b &#20013;&#x6587; &nbsp;&bogus; &#; &#xZ; &#55296;", "plain"]
    assert column(html.unescape, raw) == ["a &lt; b 中文 \xa0&bogus; &#; &#xZ; �", "plain"]


def test_element_nests(column):
    page = '<div id="a"><div>x<div>y</div></div>z</div><div>out</div>'
    assert column(lambda c: html.element(c, "div", 'id="a"'), [page]) == ["<div>x<div>y</div></div>z"]
    assert column(lambda c: html.element(c, "p"), [page]) == [None]


def test_unclosed_paragraphs(column):
    assert column(html.paragraphs, ["<h1>t</h1><p><b>a<br><p>b</p>c<p class=x>d"]) == [["a", "b", "d"]]


def test_udn(spark):
    page = """<html><h1>標 題</h1><section class="article-content__wrapper">
      <a class="breadcrumb-items">首頁</a><a class="breadcrumb-items">要聞</a><a class="breadcrumb-items">社會</a>
      <span class="article-content__author"><a href="/r">王小明</a></span>
      <time class="article-content__time">2024-10-24 08:30</time>
      <p> 第一 段 </p><p>第二段<script>var p = "</p>"</script></p></section></html>"""
    got = read(spark, page, html.UDN)
    assert got["title"] == "標 題" and got["body"] == "第一段第二段"
    assert (got["reporter"], got["date"], got["category"]) == ("王小明", "2024-10-24", "要聞/社會")


def test_setn(spark):
    page = '<h1>t</h1><time class="page_date">2024/10/24 08:30:00</time><div id="ckuse"><p>記者王小明／台北報導</p><div>內文</div></div>'
    got = read(spark, page, html.SETN)
    assert got["body"] == "記者王小明／台北報導\n內文"
    assert (got["reporter"], got["date"], got["category"]) == ("王小明", "2024-10-24", None)
    assert read(spark, "<p>x</p>", html.SETN)["date"] == "未知"


def test_ettoday_and_money(spark):
    page = '<time class="date">2024年10月24日</time><div class="story"><p>記者李四／台中報導</p>內文</div>'
    got = read(spark, page, html.ETTODAY)
    assert (got["reporter"], got["date"]) == ("李四", "2024年10月24日")
    page = """<main><div class="article-body__info"><span>經濟日報 編譯李大同／綜合</span></div><time>2024-10-24 08:30</time>
      <li class="breadcrumb__item">產業</li><section id="article_body"><p>甲</p><p>乙</p></section></main>"""
    got = read(spark, page, html.MONEY_UDN)
    assert (got["body"], got["reporter"], got["date"], got["category"]) == ("甲乙", "李大同", "2024-10-24", "None")


def test_yahoo_falls_back(spark):
    page = '<time datetime="2024-10-24T08:30:00Z">x</time><div class="article-body">記者 王五／報導</div>'
    got = read(spark, page, html.YAHOO)
    assert (got["body"], got["reporter"], got["date"]) == ("記者 王五／報導", "王五", "2024-10-24 08:30:00")
    got = read(spark, '<span class="caas-author-byline">甲</span>' + page, html.YAHOO)
    assert got["reporter"] == "甲"


PTT_PAGE = """<title>[問卦] 題</title><div id="main-content"><div class="article-metaline"><span class="article-meta-tag">作者</span>
<span class="article-meta-value">abc (暱稱)</span></div>
本文<span class="f2">※ 發信站</span>
<div class="push"><span class="push-tag">推 </span><span class="push-userid">u1</span><span class="push-content">: 好</span><span class="push-ipdatetime"> 1.2.3.4 10/24 08:00</span></div>
<div class="push"><span class="push-tag">→ </span><span class="push-userid">u2</span><span class="push-content">: 壞</span><span class="push-ipdatetime">10/24</span></div>
<div class="push"><span class="warn">too many</span></div>
<div class="push"><span class="push-tag">噓 </span><span class="push-userid">u3</span><span class="push-content">: x</span><span class="push-ipdatetime">10/24</span></div>
</div>"""


def test_ptt(spark, column):
    got = read(spark, PTT_PAGE, html.PTT)
    assert (got["body"], got["reporter"]) == ("本文", "abc (暱稱)")
    (pushes,) = column(html.pushes, [PTT_PAGE])
    assert [tuple(p) for p in pushes] == [("推", "u1", "好", "1.2.3.4 10/24 08:00"), ("→", "u2", "壞", "10/24")]
    assert column(lambda c: F.size(html.pushes(c)), ["<p>none</p>"]) == [0]


def test_without_at_any_depth(column):
    deep = "body" + "".join(f"<div>L{i}" for i in range(50)) + "</div>" * 50 + "tail<span>x</span></div>end"
    assert column(lambda c: html.without(c, ("span", "div")), [deep, "plain", "<divider>kept</divider>"]) == [
        "bodytailend", "plain", "<divider>kept</divider>",
    ]


def test_all_named_entities(column):
    from html.entities import html5

    names = [n for n in html5 if n.endswith(";")]
    assert column(html.unescape, [f"a&{n}b" for n in names]) == [f"a{html5[n]}b" for n in names]
    texts = ["caf&eacute; &uuml;ber &euro;5 &rsquo;s", "&amp;lt; &amp;amp; &amp;#65;", "&nosuch; & &; &#65;&#x42;", "AT&T &copy"]
    assert column(html.unescape, texts) == ["café über €5 ’s", "&lt; &amp; &#65;", "&nosuch; & &; AB", "AT&T &copy"]


def test_text_nodes_are_joined_without_a_gap(column):
    assert column(html.joined, ["<p>  A  </p>\n <p> B </p>"]) == ["AB"]
