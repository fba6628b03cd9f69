"""Reading elements out of raw HTML text with built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions import dates, sites
from murmur.functions.bind import once
from murmur.functions.fixed import UNCATEGORISED, UNKNOWN
from murmur.functions.text import first_non_empty, squeeze_text, strip

# Characters of all named entities of HTML5, by their names without the semicolon.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAG = r"(?s)<[^>]*>"
PARAGRAPH_OPEN = r"(?i)<p(?:\s[^>]*)?>"
PARAGRAPH_REST = r"(?is)</p>.*$"


def _code_point(n: Column) -> Column:
    ok = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    raw = F.unhex(F.lpad(F.hex(n), 8, "0"))
    return F.when(ok, F.decode(raw, "UTF-32")).otherwise(F.lit("�"))


def unescape(c: Column) -> Column:
    """Resolve numeric and all named entities in one pass, so nothing is read twice.

    The text is cut at its ampersands; what follows one is looked at by itself.
    """
    # One literal that Catalyst folds to a map, rather than thousands of them.
    names = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in ENTITIES.items())), F.lit("\x01"), F.lit("\x02"))

    def piece(p: Column, i: Column) -> Column:
        body = F.regexp_extract(p, "^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        decimal = F.substring(body, 2, 7).try_cast("bigint")
        hexadecimal = F.conv(F.substring(body, 3, 6), 16, 10).try_cast("bigint")
        char = (
            F.when(body.rlike("^#[xX]"), _code_point(hexadecimal))
            .when(body.startswith("#"), _code_point(decimal))
            .otherwise(F.try_element_at(names, body))
        )
        rest = F.substring(p, F.length(body) + 2, F.length(p))
        return F.when(i == 0, p).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), p)))

    decoded = F.array_join(F.transform(F.split(c, "&"), piece), "")
    return F.when(c.rlike("&[#A-Za-z]"), decoded).otherwise(c)


def visible(html: Column) -> Column:
    """Drop comments, scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "")


def plain(html: Column) -> Column:
    """Text of a fragment: tags dropped, entities resolved, stripped."""
    return strip(unescape(F.regexp_replace(html, TAG, "")))


def lines(html: Column) -> Column:
    """Text of a fragment, one line per text node, blank nodes dropped."""
    nodes = F.transform(F.split(html, TAG), lambda n: strip(unescape(n)))
    return F.array_join(F.filter(nodes, lambda n: n != ""), "\n")


def joined(html: Column) -> Column:
    """Text of a fragment: every text node stripped, put together without a gap."""
    return F.array_join(F.transform(F.split(html, TAG), lambda n: strip(unescape(n))), "")


def element(html: Column, tag: str, attr: str = "") -> Column:
    """Inner HTML of the first ``tag`` whose attributes match, null if absent.

    Elements of the same tag may nest: the end is the first closing tag with as
    many openings as closings before it.
    """
    opened = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*{attr}[^>]*>(.*)$", 1)
    start = F.struct(
        F.lit(0).alias("closed"), F.lit(0).alias("opened"), F.lit(False).alias("done")
    )

    def step(acc: Column, piece: Column) -> Column:
        n = acc["opened"] + F.regexp_count(piece, F.lit(rf"(?i)<{tag}\b"))
        return F.when(acc["done"], acc).otherwise(
            F.struct(
                (acc["closed"] + 1).alias("closed"),
                n.alias("opened"),
                (n == acc["closed"]).alias("done"),
            )
        )

    def inner(pieces: Column) -> Column:
        keep = F.aggregate(pieces, start, step, lambda acc: acc["closed"])
        return F.array_join(F.slice(pieces, 1, keep), f"</{tag}>")

    # Without a match the text is empty, and no element can begin at its end.
    return once(F.split(F.nullif(opened, F.lit("")), rf"(?i)</{tag}\s*>"), inner)


def elements(html: Column, tag: str, attr: str = "") -> Column:
    """Inner HTML of every matching ``tag``; such elements must not nest."""
    return F.regexp_extract_all(
        html, F.lit(rf"(?is)<{tag}\b[^>]*{attr}[^>]*>(.*?)</{tag}\s*>"), F.lit(1)
    )


def attribute(html: Column, tag: str, name: str) -> Column:
    found = F.regexp_extract(html, rf'(?is)<{tag}\b[^>]*\b{name}="([^"]*)"', 1)
    return unescape(F.nullif(found, F.lit("")))


def css_class(name: str) -> str:
    return rf'class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"'


def _tail(parts: Column) -> Column:
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def paragraphs(html: Column) -> Column:
    """Plain text of each paragraph; an unclosed one ends where the next begins."""
    inner = once(F.split(html, PARAGRAPH_OPEN), _tail)
    return F.transform(inner, lambda p: plain(F.regexp_replace(p, PARAGRAPH_REST, "")))


def without(html: Column, tags: Sequence[str]) -> Column:
    """Drop whole elements of the given tags, nested to any depth.

    The text is cut before each tag; a running depth of open elements tells which
    pieces lie outside all of them. A closing tag that closes nothing is dropped alone.
    """
    names = "|".join(tags)
    opens, closes = rf"(?i)^<(?:{names})\b[^>]*>", rf"(?i)^</(?:{names})\s*>"
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, piece: Column) -> Column:
        opened, closed = piece.rlike(opens), piece.rlike(closes)
        depth = F.when(opened, acc["depth"] + 1).when(closed, F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"])
        rest = F.when(closed, F.regexp_replace(piece, closes, "")).otherwise(piece)
        kept = F.when((depth == 0) & ~opened, F.concat(acc["kept"], F.array(rest))).otherwise(acc["kept"])
        return F.struct(depth.alias("depth"), kept.alias("kept"))

    def outside(pieces: Column) -> Column:
        return F.aggregate(pieces, start, step, lambda acc: F.array_join(acc["kept"], ""))

    return once(F.split(html, rf"(?i)(?=</?(?:{names})\b)"), outside)


def pushes(html: Column) -> Column:
    """Push structs (tag, user, content, time) of a board page, in order.

    Reading stops at the first push without a tag.
    """
    parts = once(F.split(html, r'(?i)<div\b[^>]*class="push(?:\s[^"]*)?"[^>]*>'), _tail)

    def span(part: Column, name: str) -> Column:
        return plain(F.regexp_extract(part, rf'(?is)<span\b[^>]*{css_class(name)}[^>]*>(.*?)</span>', 1))

    def read(part: Column) -> Column:
        return F.struct(
            F.when(part.rlike(rf'(?i)<span\b[^>]*{css_class("push-tag")}'), span(part, "push-tag")).alias("tag"),
            span(part, "push-userid").alias("user"),
            sites.comment_prefix_strip(span(part, "push-content")).alias("content"),
            span(part, "push-ipdatetime").alias("time"),
        )

    def until_bad(found: Column) -> Column:
        bad = F.array_position(F.transform(found, lambda p: p["tag"].isNull()), F.lit(True))
        return F.when(bad > 0, F.slice(found, 1, bad.cast("int") - 1)).otherwise(found)

    return once(F.transform(parts, read), until_bad)


@dataclass(frozen=True)
class PageRules:
    """How one site lays out an article. Each list is tried in order."""

    scope: Sequence[tuple[str, str]]
    title: Sequence[tuple[str, str]] = (("h1", ""), ("title", ""))
    date: Sequence[tuple[str, str]] = (("time", ""),)
    reporter: Sequence[tuple[str, str]] = ()
    crumbs: tuple[str, str] | None = None
    body: str = "squeezed"
    reporter_rule: str = "text"
    date_rule: str = "day"
    no_reporter: str | None = UNKNOWN
    no_category: str | None = UNCATEGORISED
    drop: Sequence[str] = field(default=())


# Fixed layouts.
GENERIC = PageRules(
    scope=(("article", ""),),
    body="paragraphs",
    date_rule="raw",
    no_reporter=None,
    no_category=None,
)
PTT = PageRules(
    scope=(("div", 'id="main-content"'),),
    title=(("title", ""),),
    date=(),
    reporter=(("span", css_class("article-meta-value")),),
    body="text",
    drop=("span", "div"),
    date_rule="raw",
    no_category=None,
)
ETTODAY = PageRules(
    scope=(("div", css_class("story")),),
    date=(("time", css_class("date")),),
    reporter=(("p", css_class("story_author")),),
    body="joined",
    reporter_rule="between",
    date_rule="raw",
    no_reporter="",
    no_category=None,
)
SETN = PageRules(
    scope=(("div", 'id="ckuse"'),),
    date=(("time", css_class("page_date")),),
    body="lines",
    reporter_rule="slash",
    no_category=None,
)
UDN = PageRules(
    scope=(("section", css_class("article-content__wrapper")),),
    date=(("time", css_class("article-content__time")),),
    reporter=(("span", css_class("article-content__author")),),
    crumbs=("a", css_class("breadcrumb-items")),
    no_reporter="None",
)
MONEY_UDN = PageRules(
    scope=(("section", 'id="article_body"'),),
    reporter=(("div", css_class("article-body__info")),),
    crumbs=("li", css_class("breadcrumb__item")),
    reporter_rule="editor",
    no_category="None",
)
YAHOO = PageRules(
    scope=(
        ("div", css_class("caas-body")),
        ("div", css_class("article-body")),
        ("div", css_class("canvas-body")),
    ),
    reporter=(
        ("[a-z]+", css_class("caas-author-byline")),
        ("[a-z]+", css_class("author-name")),
        ("[a-z]+", css_class("byline")),
    ),
    body="joined",
    reporter_rule="byline",
    date_rule="iso",
    no_reporter=None,
    no_category=None,
)


def first_text(html: Column, selectors: Sequence[tuple[str, str]]) -> Column:
    texts = [
        plain(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*{attr}[^>]*>(.*?)</(?:{tag})\s*>", 1))
        for tag, attr in selectors
    ]
    return first_non_empty(*texts) if texts else F.lit(None).cast("string")


def read_article(html: Column, rules: PageRules) -> dict[str, Column]:
    """Expressions for title, body, reporter, date and category of a page."""
    page = visible(html)
    scope = F.coalesce(*(element(page, tag, attr) for tag, attr in rules.scope))
    inner = without(scope, rules.drop) if rules.drop else scope
    body = {
        "squeezed": lambda: squeeze_text(paragraphs(inner)),
        "paragraphs": lambda: F.array_join(paragraphs(inner), "\n"),
        "text": lambda: plain(inner),
        "lines": lambda: lines(inner),
        "joined": lambda: joined(inner),
    }[rules.body]()
    named = first_text(page, rules.reporter)
    reporter = {
        "text": lambda: named,
        "between": lambda: sites.reporter_between(first_non_empty(named, plain(inner))),
        "slash": lambda: sites.reporter_slash(plain(inner)),
        "editor": lambda: sites.reporter_or_editor(named),
        "byline": lambda: F.coalesce(named, sites.reporter_byline(plain(page))),
    }[rules.reporter_rule]()
    shown = first_text(page, rules.date)
    date = {
        "raw": lambda: shown,
        "day": lambda: dates.date_news(shown),
        "iso": lambda: dates.date_news_iso(attribute(page, "time", "datetime")),
    }[rules.date_rule]()
    if rules.crumbs:
        crumbs = F.transform(elements(page, *rules.crumbs), plain)
        category = sites.category_path(crumbs, rules.no_category)
    else:
        category = F.lit(rules.no_category).cast("string")
    return {
        "title": first_text(page, rules.title),
        "body": body,
        "reporter": F.coalesce(reporter, F.lit(rules.no_reporter)),
        "date": date,
        "category": category,
    }
