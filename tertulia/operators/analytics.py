"""Figures behind the dashboards and notebooks.

Inputs are marts (a row per source and day at most) unless the name says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.functions.dates import month_start
from tertulia.functions.text import strip
from tertulia.operators.dedup import keep_first

LABELS = ("positive", "neutral", "negative")


def normalize_label(df: DataFrame, label: str = "sentiment", known: Sequence[str] = LABELS) -> DataFrame:
    """Strip and lower-case labels, keep known ones."""
    return df.withColumn(label, F.lower(strip(label))).where(F.col(label).isin(list(known)))


def overall_sentiment(dist: DataFrame) -> DataFrame:
    """Records per label over all sources, with the total and the percent share."""
    counts = normalize_label(dist).groupBy("sentiment").agg(F.sum("count").alias("count"))
    # At most one row per known label reaches this window.
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select("sentiment", "count", total.alias("total"),
                         (F.col("count") * 100.0 / total).alias("share"))


def sentiment_by_source(dist: DataFrame) -> DataFrame:
    return dist.select("source", "sentiment", "count")


def sentiment_series(trend: DataFrame) -> DataFrame:
    return trend.select("source", "day", "avg_polarity").orderBy("source", F.asc_nulls_last("day"))


def polarity_box(trend: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(boxes, outliers) of daily polarity per source.

    Quartiles follow the box plot rule (rank p·n - 1/2). Whiskers reach the furthest
    value within 1.5 IQR of the box; values beyond them are outliers.
    """
    days = Window.partitionBy("source")  # a source has a row for each day, so few
    rank = F.row_number().over(days.orderBy("avg_polarity")) - 1
    marked = trend.where("avg_polarity is not null").select("source", "day", "avg_polarity").withColumns(
        {"_rank": rank, "_n": F.count(F.lit(1)).over(days)})

    def quartile(p: float) -> Column:
        at = F.least(F.greatest(F.col("_n") * F.lit(p) - 0.5, F.lit(0.0)), (F.col("_n") - 1).cast("double"))
        low, high = (F.max(F.when(F.col("_rank") == r, F.col("avg_polarity"))).over(days) for r in (F.floor(at), F.ceil(at)))
        return low + (at - F.floor(at)) * (high - low)

    marked = marked.withColumns({"q1": quartile(0.25), "median": quartile(0.5), "q3": quartile(0.75)})
    iqr = F.col("q3") - F.col("q1")
    marked = marked.withColumn("_inside", F.col("avg_polarity").between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr))
    inside = F.when(F.col("_inside"), F.col("avg_polarity"))
    summary = marked.groupBy("source", "q1", "median", "q3").agg(
        F.least(F.min(inside), F.col("q1")).alias("lower_whisker"),
        F.greatest(F.max(inside), F.col("q3")).alias("upper_whisker"),
        F.count_if(~F.col("_inside")).alias("outliers"))
    return summary, marked.where(~F.col("_inside")).select("source", "day", "avg_polarity")


def polarity_volume(trend: DataFrame) -> DataFrame:
    return trend.select("day", "source", "avg_polarity", "record_count")


def polarity_ma7(trend: DataFrame, rows: int = 7) -> DataFrame:
    """Mean of the last seven rows (not days) per source."""
    last = Window.partitionBy("source").orderBy(F.asc_nulls_last("day")).rowsBetween(-(rows - 1), 0)
    return trend.withColumn("polarity_ma_7d", F.avg("avg_polarity").over(last))


def polarity_ma_days(trend: DataFrame, days: int = 7) -> DataFrame:
    """Mean over the last seven calendar days per source; rows without a day are left out."""
    last = Window.partitionBy("source").orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return trend.where("day is not null").withColumn("polarity_ma_days", F.avg("avg_polarity").over(last))


def monthly_polarity(trend: DataFrame) -> DataFrame:
    """Mean of daily means per source and month, not weighted by volume."""
    return trend.where("source is not null and day is not null").groupBy(
        "source", month_start("day").alias("month")).agg(F.avg("avg_polarity").alias("avg_polarity"))


def polarity_vs_score(trend: DataFrame, scores: DataFrame, source: str) -> DataFrame:
    """Trend of one source joined to its score trend; rows without a day match each other."""
    right = scores.withColumnRenamed("day", "_day")
    return trend.where(F.col("source") == source).join(
        right, F.col("day").eqNullSafe(F.col("_day"))).drop("_day")


def volume_series(volume: DataFrame) -> DataFrame:
    return volume.select("source", "day", "record_count").orderBy("source", F.asc_nulls_last("day"))


def top20_keywords(keywords: DataFrame, n: int = 20) -> DataFrame:
    return keywords.orderBy(F.desc("frequency"), "word", "source").limit(n)


def top10_per_sentiment(keywords: DataFrame, n: int = 10) -> DataFrame:
    """Ten words per label, summed over sources.

    Given the cut `keywords_sentiment` mart it counts only words in that cut, as the
    published chart does; given `word_facts` with `n` renamed to `frequency` it is uncut.
    """
    summed = normalize_label(keywords).groupBy("word", "sentiment").agg(F.sum("frequency").alias("frequency"))
    rank = F.row_number().over(Window.partitionBy("sentiment").orderBy(F.desc("frequency"), "word"))
    return summed.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def share_by_source(dist: DataFrame) -> DataFrame:
    """Percent of a source's records per label; the total includes unknown labels."""
    total = F.sum("count").over(Window.partitionBy("source"))
    shares = dist.select(
        "source", "sentiment", "count", F.bround(F.col("count") * 100.0 / total, 2).alias("percentage"))
    return normalize_label(shares)


def label_order(label: Column | str = "sentiment") -> Column:
    """Sort key: positive, neutral, negative."""
    return F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col(label) if isinstance(label, str) else label)


def score_series(scores: DataFrame) -> DataFrame:
    return scores.select("day", "avg_score").orderBy(F.asc_nulls_last("day"))


# Notebook figures, over silver tables of any size.

def combine_snapshots(snapshots: DataFrame, order: Sequence[str], url: str = "url") -> DataFrame:
    """All snapshots as one table, first row per url."""
    return keep_first(snapshots, [url], order)


def basic_stats(posts: DataFrame, score: str = "score") -> DataFrame:
    return posts.agg(
        F.count(F.lit(1)).alias("posts"),
        F.bround(F.avg(score), 2).alias("avg_score"), F.max(score).alias("max_score"))


def top5_by_score(posts: DataFrame, n: int = 5, tie: Sequence[str] = ("title", "author")) -> DataFrame:
    return posts.select("title", "score", "author", *[c for c in tie if c not in ("title", "author")]).orderBy(
        F.desc_nulls_last("score"), *[F.asc_nulls_last(c) for c in tie]).limit(n).select("title", "score", "author")


def distinct_authors(articles: DataFrame, author: str = "author", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(author) if approximate else F.count_distinct(F.col(author))
    return articles.agg(count.alias("distinct_authors"))


def author_counts(articles: DataFrame, author: str = "author", n: int = 10) -> DataFrame:
    return (
        articles.where(F.col(author).isNotNull()).groupBy(author).agg(F.count(F.lit(1)).alias("articles"))
        .orderBy(F.desc("articles"), author).limit(n)
    )


def preview(df: DataFrame, n: int = 5, order: Sequence[Column | str] = ()) -> DataFrame:
    """The first rows, in a stated order if there is one."""
    return (df.orderBy(*order) if order else df).limit(n)
