"""Articles from listing and article pages. Selectors are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.functions.batches import bounded_batches
from tertulia.functions.html import Fields, html_fields
from tertulia.functions.text import absolute_url, class_tags, distinct_tags, strip

# Selectors of the listing and article templates.
LISTING_ITEM = ("article[data-post-id]",)
LISTING: Fields = {
    "title": [("h2.entry-title a", "text")],
    "url": [("h2.entry-title a", "href")],
    "author": [("span[class='author vcard'] a", "text")],
    "date": [("time.entry-date", "datetime"), ("time.entry-date", "text")],
    "excerpt": [("div.entry-wrapper p", "text")],
    "classes": [(".", "class")],
}
DETAIL: Fields = {"body": [(".entry-content", "spaced")], "tags": [("*a[rel~=tag]", "text")]}
NEXT: Fields = {
    "next": [("div.nav-links a.next", "text"), ("nav.pagination a.next", "text"), ("a.page-numbers.next", "text")],
    "rel_next": [("a[rel=next]", "href")],
}
CARD_ITEM = ("article", ".card, .post-card, [class*=article]")
CARD: Fields = {
    "title": [(s, "visible") for s in ("h1", "h2", "h3", ".title", "[class*=title]")],
    "url": [("a", "href")],
    "author": [(s, "visible") for s in
               (".author", ".autor", ".byline", "[class*=author]", "[class*=autor]", "[rel=author]")],
    "date": [(s, w) for s in ("time", "[datetime]", ".date", ".fecha", "[class*=date]")
             for w in ("datetime", "visible")],
    "excerpt": [(s, "visible") for s in ("p", ".excerpt", ".summary", "[class*=excerpt]")],
}
LINK_ITEM = ("h2 a, h3 a",)
LINK: Fields = {"title": [(".", "visible")], "url": [(".", "href")]}
ARTICLE: Fields = {
    "body": [(s, "visible") for s in (
        ".post-content", ".entry-content", ".article-content", "[class*=content__body]",
        "[class*=article__body]", "[class*=story-body]", "article .body", "article")],
    "tags": [("*.tags-links a[rel=tag]", "visible")],
    "any_tags": [("*a[rel=tag]", "visible")],
}


def _first(c: str) -> Column:
    """First candidate whose element exists, even if its text is empty."""
    return F.get(F.filter(c, lambda v: v.isNotNull()), F.lit(0))


def _first_longer(c: str, chars: int) -> Column:
    """First candidate longer than `chars`."""
    return F.get(F.filter(F.transform(c, strip), lambda v: F.length(v) > chars), F.lit(0))


def _text(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def _items(pages: DataFrame, html: str, fields: Fields, items: Sequence[str], keep: Sequence[str]) -> DataFrame:
    bounded_batches(pages.sparkSession)
    found = html_fields(html, {"items": (items, fields)})["items"]
    return pages.select(*keep, found.alias("_items")).select(
        *keep, F.posexplode("_items").alias("item_pos", "_item")).select(*keep, "item_pos", "_item.*")


def extract_listing(
    pages: DataFrame,
    html: str = "html",
    keep: Sequence[str] = (),
    item: Sequence[str] = LISTING_ITEM,
    fields: Fields = LISTING,
    excerpt_chars: int = 300,
) -> DataFrame:
    """One row per listed article with a link, in page order (`item_pos`).

    Untitled rows are kept for `first_seen_url`, which drops them after the link counts
    as seen.
    """
    cards = _items(pages, html, fields, item, keep).select(
        *keep, "item_pos",
        F.coalesce(_first("title"), F.lit("")).alias("title"),
        _text(_first("url")).alias("url"),
        F.coalesce(_first("author"), F.lit("")).alias("author"),
        F.coalesce(_first("date"), F.lit("")).alias("date"),
        F.substring(F.coalesce(_first("excerpt"), F.lit("")), 1, excerpt_chars).alias("excerpt"),
        class_tags(_first("classes")).alias("tags"),
    )
    return cards.where("url <> ''")


def extract_detail(pages: DataFrame, html: str = "html", keep: Sequence[str] = (), fields: Fields = DETAIL) -> DataFrame:
    """Article body and distinct tags, a row per page."""
    return _items(pages, html, fields, (), keep).select(
        *keep, F.coalesce(_first("body"), F.lit("")).alias("body"), distinct_tags("tags").alias("tags"))


def extract_cards(
    pages: DataFrame,
    html: str = "html",
    host: str = "",
    keep: Sequence[str] = (),
    item: Sequence[str] = CARD_ITEM,
    fields: Fields = CARD,
    excerpt_chars: int = 300,
    excerpt_min: int = 20,
) -> DataFrame:
    """Titled cards by ordered selector alternatives; a page without any gives its heading links."""
    bounded_batches(pages.sparkSession)
    found = pages.select(*keep, html_fields(html, {"cards": (item, fields), "links": (LINK_ITEM, LINK)}).alias("_f"))

    def text(c: Column, chars: int | None = None) -> Column:
        values = F.filter(F.transform(c, strip), lambda v: v.isNotNull() if chars is None else F.length(v) > chars)
        return F.coalesce(F.get(values, F.lit(0)), F.lit(""))

    def url(c: Column) -> Column:
        href = F.get(c, F.lit(0))
        return F.when(href.isNull(), "").otherwise(absolute_url(href, host))

    def card(c: Column) -> Column:
        # Candidates alternate attribute, text: an empty attribute gives way to the text.
        dates = F.transform(c["date"], lambda v, i: F.when((i % 2 == 1) | (v != ""), v))
        return F.struct(
            text(c["title"]).alias("title"), text(c["author"]).alias("author"), text(dates).alias("date"),
            url(c["url"]).alias("url"),
            F.substring(text(c["excerpt"], excerpt_min), 1, excerpt_chars).alias("excerpt"))

    def link(c: Column) -> Column:
        none = F.lit("")
        return F.struct(
            text(c["title"]).alias("title"), none.alias("author"), none.alias("date"),
            absolute_url(F.get(c["url"], F.lit(0)), host).alias("url"), none.alias("excerpt"))

    def titled(items: Column, make) -> Column:
        return F.filter(F.transform(items, make), lambda c: c["title"] != "")

    return (
        found.withColumn("_cards", titled(F.col("_f.cards"), card))
        .withColumn("_cards", F.when(F.size("_cards") > 0, F.col("_cards")).otherwise(titled(F.col("_f.links"), link)))
        .select(*keep, F.posexplode("_cards").alias("item_pos", "_card"))
        .select(*keep, "item_pos", "_card.*")
    )


def article_fields(
    pages: DataFrame, html: str = "html", keep: Sequence[str] = (), fields: Fields = ARTICLE, min_chars: int = 100
) -> DataFrame:
    """Body from the first alternative longer than `min_chars`; tags from the tag list, else any tag link."""
    listed = F.array_join(F.filter(F.transform("tags", strip), lambda t: t != ""), ", ")
    return _items(pages, html, fields, (), keep).select(
        *keep,
        F.coalesce(_first_longer("body", min_chars), F.lit("")).alias("body"),
        F.coalesce(F.nullif(listed, F.lit("")), distinct_tags("any_tags")).alias("tags"),
    )


def next_page(
    pages: DataFrame, base: str, page: str = "page", html: str = "html", host: str = "", keep: Sequence[str] = ()
) -> DataFrame:
    """`has_next`, and `next_url`: the rel=next link if there is one, else `<base>page/N+1/`."""
    href = _first("rel_next")
    guess = F.concat(F.lit(base), F.lit("page/"), (F.col("_page") + 1).cast("string"), F.lit("/"))
    return _items(pages.withColumn("_page", F.col(page)), html, NEXT, (), [*keep, "_page"]).select(
        *keep,
        F.exists("next", lambda v: v.isNotNull()).alias("has_next"),
        F.when(href.isNotNull(), absolute_url(href, host)).otherwise(guess).alias("next_url"),
    )


def page_errors(pages: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """The pages that can't be read at all, with the reason; their fields are empty elsewhere."""
    bounded_batches(pages.sparkSession)
    found = pages.select(*keep, html_fields(html, {"page": ((), {"any": (("html", "lang"),)})}).alias("_f"))
    return found.where("_f.error IS NOT NULL").select(*keep, F.col("_f.error").alias("error"))
