"""Bronze: raw API pages and listings to validated records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.functions.text import first_non_empty, has_keyword, is_blank, strip
from tertulia.functions.wordlists import KEYWORDS
from tertulia.operators.dedup import keep_first

API_PAGE = (
    "data struct<children: array<struct<data: struct<"
    "title: string, selftext: string, author: string, created_utc: double, "
    "score: bigint, permalink: string, pinned: boolean>>>>"
)
POST_KEYS = ("title", "author", "date", "url", "source")
ARTICLE_KEYS = ("titulo", "autor", "fecha", "url", "contenido")
POSTS_PER_PULL = 20
MIN_POST_CHARS = 20
EXCERPT_CHARS = 300


def flatten_api(pages: DataFrame, body: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per post of a raw API page, with its position; missing levels give no rows."""
    page = F.from_json(F.col(body), API_PAGE)
    return (
        pages.select(*keep, F.posexplode(page["data"]["children"]).alias("pos", "child"))
        .select(*keep, "pos", "child.data.*")
    )


def drop_pinned(posts: DataFrame, pinned: str = "pinned") -> DataFrame:
    return posts.where(~F.coalesce(F.col(pinned), F.lit(False)))


def combined_text(title: str = "title", body: str = "selftext") -> Column:
    """Lower-cased title, one space, body; missing parts count as empty."""
    return F.lower(F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(body), F.lit(""))))


def min_combined_length(
    posts: DataFrame, title: str = "title", body: str = "selftext", chars: int = MIN_POST_CHARS
) -> DataFrame:
    return posts.where(F.length(strip(combined_text(title, body))) >= chars)


def keyword_filter(
    posts: DataFrame, title: str = "title", body: str = "selftext", keywords: Iterable[str] = KEYWORDS
) -> DataFrame:
    return posts.where(has_keyword(combined_text(title, body), keywords))


def project_post(posts: DataFrame, host: str, source: str, ingested_at: Column | str, keep: Sequence[str] = ()) -> DataFrame:
    """The bronze post record: renamed, defaulted, with an absolute link."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return posts.select(
        *keep,
        text("title").alias("title"),
        text("selftext").alias("text"),
        text("author").alias("author"),
        F.col("created_utc").alias("date"),
        F.coalesce(F.col("score"), F.lit(0).cast("bigint")).alias("score"),
        F.concat(F.lit(host), text("permalink")).alias("url"),
        F.lit(source).alias("source"),
        (F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at).alias("ingested_at"),
    )


def first_n_per_batch(
    df: DataFrame, batch: Sequence[str], order: Sequence[str], n: int = POSTS_PER_PULL
) -> DataFrame:
    """The first `n` rows of each batch. Spark limits each batch before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy(*batch).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_seen_url(
    cards: DataFrame, order: Sequence[str], url: str = "url", title: str = "title"
) -> DataFrame:
    """First card per link, then cards with a title: a link counts as seen even untitled."""
    seen = keep_first(cards.where(F.coalesce(F.col(url), F.lit("")) != ""), [url], order)
    return seen.where(F.coalesce(F.col(title), F.lit("")) != "")


def enrich_detail(
    listing: DataFrame,
    detail: DataFrame,
    url: str = "url",
    body: str = "contenido",
    tags: str = "etiquetas",
    excerpt: str = "extracto",
    chars: int | None = EXCERPT_CHARS,
) -> DataFrame:
    """Attach the article body by link. `detail` holds one row per url.

    Detail tags replace listing tags if there are any; an empty excerpt becomes the
    start of the body, or all of it if `chars` is None.
    """
    extra = detail.select(F.col(url), F.col(body).alias("_body"), F.col(tags).alias("_tags"))
    joined = listing.drop(body).join(extra, url, "left")
    found = F.coalesce(F.col("_body"), F.lit(""))
    kept = [c for c in listing.columns if c not in (body, tags, excerpt)]
    return joined.select(
        *kept,
        first_non_empty("_tags", tags).alias(tags),
        first_non_empty(F.col(excerpt), found if chars is None else F.substring(found, 1, chars)).alias(excerpt),
        found.alias(body),
    )


def missing_keys(record: Column | str, required: Sequence[str]) -> Column:
    """Required keys absent from a `map<string,string>`; a key present with null is not absent.
    A record that couldn't be read lacks them all."""
    record = F.col(record) if isinstance(record, str) else record
    return F.array_except(F.array(*[F.lit(k) for k in required]), F.coalesce(F.map_keys(record), F.array().cast("array<string>")))


def validate(records: DataFrame, required: Sequence[str], title: str, record: str = "record") -> DataFrame:
    """Add `missing` (sorted absent keys) and `empty_title` to raw records."""
    return records.withColumn("missing", F.array_sort(missing_keys(record, required))).withColumn(
        "empty_title", is_blank(F.col(record)[title]))


def validation_summary(validated: DataFrame, by: str = "source") -> DataFrame:
    """Records and warnings per source; a record can give two warnings."""
    warnings = (F.size("missing") > 0).cast("bigint") + F.col("empty_title").cast("bigint")
    return validated.groupBy(by).agg(
        F.count(F.lit(1)).alias("records"), F.sum(warnings).alias("warnings"))


def scraped_batch_clean(
    articles: DataFrame, order: Sequence[str], url: str = "url", title: str = "titulo", chars: int = 3
) -> DataFrame:
    """First row per link, then titles longer than `chars`."""
    return keep_first(articles, [url], order).where(F.length(title) > chars)
