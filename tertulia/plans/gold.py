"""Silver tables to the governance table and the seven marts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tertulia.functions.sentiment import with_sentiment
from tertulia.functions.wordlists import NEGATIVE, POSITIVE
from tertulia.operators import corpus as c
from tertulia.operators import marts, quality
from tertulia.sources.snapshots import write_snapshot


def scored_corpus(
    posts: DataFrame | None,
    articles: DataFrame | None,
    positive: Iterable[str] = POSITIVE,
    negative: Iterable[str] = NEGATIVE,
    posts_source: str = "posts",
    articles_source: str = "articles",
    order: Sequence[str] = ("source", "day", "title", "author", "score", "text"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Unified, deduplicated and scored records: per url, the first in `order`.

    `keep` names silver columns such as `run_ts` to carry along for use in `order`.
    """
    frames = []
    if posts is not None:
        frames.append(c.normalize_posts(posts, posts_source, keep))
    if articles is not None:
        frames.append(c.normalize_articles(articles, articles_source, keep))
    if not frames:
        raise ValueError("no silver table")
    first = c.dedup_url(c.union_sources(frames), order).select(*c.COLUMNS)
    return with_sentiment(first, "text", positive, negative, separator=" ")


def build_marts(corpus: DataFrame, daily: DataFrame, word_counts: DataFrame, score_source: str) -> dict[str, DataFrame]:
    """The seven marts, from a corpus and its two fact tables."""
    return {
        "volume": marts.volume_trend(daily),
        "keywords": marts.top_keywords(word_counts),
        "score_trend": marts.score_trend(daily, score_source),
        "authors": marts.top_authors(corpus),
        "sentiment_dist": marts.sentiment_dist(daily),
        "sentiment_trend": marts.sentiment_trend(daily),
        "keywords_sentiment": marts.keywords_sentiment(word_counts),
    }


def write_marts(
    spark: SparkSession, corpus: DataFrame, path: str, run_ts: str, score_source: str = "posts"
) -> dict[str, str]:
    """Write the corpus, its fact tables and the marts of one run; returns their paths.

    The corpus is written once: dedupe and scoring run once, every mart sees the same
    rows and reads only its columns, and a lost executor costs no recomputation.
    """
    def saved(df: DataFrame, name: str) -> DataFrame:
        target = f"{path}/{name}"
        write_snapshot(df, target, run_ts)
        return spark.read.schema(df.schema).parquet(f"{target}/run_ts={run_ts}")

    scored = saved(corpus, "corpus")
    daily = saved(marts.daily_facts(scored), "daily_facts")
    word_counts = saved(marts.word_facts(scored), "word_facts")
    out = {}
    for name, mart in build_marts(scored, daily, word_counts, score_source).items():
        out[name] = f"{path}/storytelling_{name}"
        write_snapshot(marts.published(mart), out[name], run_ts)
    return out


def governance(sources: Mapping[str, Mapping], computed_at: str) -> DataFrame:
    """The governance table. Each source names its table and `governance_row` arguments."""
    return quality.governance_summary(
        [quality.governance_row(source=name, computed_at=computed_at, **args) for name, args in sources.items()])
