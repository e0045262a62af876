"""Raw API pages and listing pages to bronze records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.functions.wordlists import KEYWORDS
from tertulia.operators import bronze, pages


def posts_from_pages(
    raw: DataFrame,
    host: str,
    source: str,
    ingested_at: str,
    batch: str = "source_file",
    keywords: Iterable[str] = KEYWORDS,
    n: int = bronze.POSTS_PER_PULL,
) -> DataFrame:
    """The first `n` relevant posts of every pull."""
    posts = bronze.drop_pinned(bronze.flatten_api(raw, keep=[batch]))
    relevant = bronze.keyword_filter(bronze.min_combined_length(posts), keywords=keywords)
    first = bronze.first_n_per_batch(relevant, [batch], ["pos"], n)
    return bronze.project_post(first, host, source, ingested_at, keep=[batch, "pos"])


def articles_from_html(
    listings: DataFrame, details: DataFrame, source: str, ingested_at: str, order: Sequence[str]
) -> DataFrame:
    """Listed articles, first seen link first, with body and tags of their own page.

    `listings` holds (`html`, the `order` columns); `details` holds (`url`, `html`), a
    row per url.
    """
    cards = pages.extract_listing(listings, keep=order)
    first = bronze.first_seen_url(cards, [*order, "item_pos"]).select(
        F.col("title").alias("titulo"), F.col("author").alias("autor"), F.col("date").alias("fecha"), "url",
        F.col("excerpt").alias("extracto"), F.col("tags").alias("etiquetas"), F.lit("").alias("contenido"))
    bodies = pages.extract_detail(details, keep=["url"]).select(
        "url", F.col("body").alias("contenido"), F.col("tags").alias("etiquetas"))
    return bronze.enrich_detail(first, bodies).select(
        "titulo", "autor", "fecha", "url", "extracto", "etiquetas", "contenido",
        F.lit(source).alias("fuente"), F.lit(ingested_at).alias("ingested_at"))
