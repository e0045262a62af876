"""Marts over a scored corpus.

The day and sentiment marts also accept `daily_facts`, and the word marts accept
`word_facts`: small tables that hold the sums those marts need, so that a run over a
large corpus reads it once per fact table, not once per mart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.operators.topk import top_counts

TOP_KEYWORDS = 50
TOP_AUTHORS = 20
TOP_SENTIMENT_KEYWORDS = 300
MIN_WORD_CHARS = 4

# The published column names of the marts, where they differ from ours.
PUBLISHED_NAMES = {"day": "fecha", "author": "autor"}


def published(mart: DataFrame) -> DataFrame:
    return mart.withColumnsRenamed({k: v for k, v in PUBLISHED_NAMES.items() if k in mart.columns})


def daily_facts(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("source", "day", "sentiment").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("score").alias("score_sum"), F.count("score").alias("score_n"),
        F.sum(F.col("polarity").cast("double")).alias("polarity_sum"), F.count("polarity").alias("polarity_n"),
    )


def words(corpus: DataFrame, min_chars: int = MIN_WORD_CHARS) -> DataFrame:
    """One row per word of the clean text that is long enough."""
    kept = [c for c in ("sentiment", "source") if c in corpus.columns]
    return corpus.select(F.explode(F.split("text", " ")).alias("word"), *kept).where(F.length("word") >= min_chars)


def word_facts(corpus: DataFrame) -> DataFrame:
    return words(corpus).groupBy("word", "sentiment", "source").agg(F.count(F.lit(1)).alias("n"))


def _rows(df: DataFrame) -> Column:
    return F.sum("n") if "n" in df.columns else F.count(F.lit(1))


def _mean(df: DataFrame, c: str) -> Column:
    if f"{c}_sum" in df.columns:
        return F.try_divide(F.sum(f"{c}_sum").cast("double"), F.sum(f"{c}_n"))
    return F.avg(c)


def volume_trend(df: DataFrame) -> DataFrame:
    return df.groupBy("source", "day").agg(_rows(df).alias("record_count"))


def top_keywords(df: DataFrame, n: int = TOP_KEYWORDS) -> DataFrame:
    """The `n` most frequent (word, source) pairs over all sources; ties by word, then source."""
    tokens = df if "word" in df.columns else words(df.select("text", "source"))
    return (
        tokens.groupBy("word", "source").agg(_rows(tokens).alias("frequency"))
        .orderBy(F.desc("frequency"), "word", "source").limit(n)
    )


def top_keywords_by_bound(corpus: DataFrame, n: int = TOP_KEYWORDS) -> DataFrame:
    """`top_keywords` of a corpus whose vocabulary is too large to shuffle."""
    texts = corpus.select(F.col("text").alias("word"), "source")
    return top_counts(texts, ["word", "source"], n, words="word", min_chars=MIN_WORD_CHARS)


def score_trend(df: DataFrame, source: str) -> DataFrame:
    return df.where(F.col("source") == source).groupBy("day").agg(
        _mean(df, "score").alias("avg_score"), _rows(df).alias("post_count"))


def top_authors(corpus: DataFrame, n: int = TOP_AUTHORS) -> DataFrame:
    return (
        corpus.groupBy("author", "source").agg(_rows(corpus).alias("article_count"))
        .orderBy(F.desc("article_count"), F.asc_nulls_last("author"), "source").limit(n)
    )


def sentiment_dist(df: DataFrame) -> DataFrame:
    return df.groupBy("source", "sentiment").agg(_rows(df).alias("count"))


def sentiment_trend(df: DataFrame) -> DataFrame:
    return df.groupBy("day", "source").agg(
        _mean(df, "polarity").alias("avg_polarity"), _rows(df).alias("record_count"))


def keywords_sentiment(df: DataFrame, n: int = TOP_SENTIMENT_KEYWORDS) -> DataFrame:
    tokens = df if "word" in df.columns else words(df)
    return (
        tokens.groupBy("word", "sentiment", "source").agg(_rows(tokens).alias("frequency"))
        .orderBy(F.desc("frequency"), "word", "sentiment", "source").limit(n)
    )


def keywords_sentiment_by_bound(corpus: DataFrame, n: int = TOP_SENTIMENT_KEYWORDS) -> DataFrame:
    """`keywords_sentiment` of a corpus whose vocabulary is too large to shuffle."""
    texts = corpus.select(F.col("text").alias("word"), "sentiment", "source")
    return top_counts(texts, ["word", "sentiment", "source"], n, words="word", min_chars=MIN_WORD_CHARS)
