"""One corpus from several sources: url, title, text, author, day, score, source."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.operators.dedup import keep_first

COLUMNS = ("url", "title", "text", "author", "day", "score", "source")


def normalize_posts(posts: DataFrame, source: str = "posts", keep: Sequence[str] = ()) -> DataFrame:
    """Silver posts to corpus rows; the text is the clean title and the clean body."""
    return posts.select(
        "url", "title",
        F.concat_ws(" ", "title_clean", "text_clean").alias("text"),
        "author",
        F.to_date(F.col("date").cast("timestamp")).alias("day"),
        F.col("score").cast("bigint").alias("score"),
        F.lit(source).alias("source"),
        *keep,
    )


def normalize_articles(articles: DataFrame, source: str = "articles", keep: Sequence[str] = ()) -> DataFrame:
    """Silver articles to corpus rows; the text is the clean body only and the score is 0."""
    return articles.select(
        "url",
        F.col("titulo").alias("title"),
        F.col("contenido_clean").alias("text"),
        F.col("autor").alias("author"),
        F.to_date(F.col("fecha").cast("timestamp")).alias("day"),
        F.lit(0).cast("bigint").alias("score"),
        F.lit(source).alias("source"),
        *keep,
    )


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def dedup_url(corpus: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per url across snapshots and sources, the first in `order`."""
    return keep_first(corpus, ["url"], order)
