"""Data quality: governance figures per source, and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.operators.quantiles import exact_quantiles

FIELDS = ("title", "author", "text", "url")


def percent(part: Column, total: Column) -> Column:
    return F.coalesce(F.bround(F.try_divide(part * F.lit(100.0), total), 2), F.lit(0.0))


def _missing(c: str) -> Column:
    return F.count_if(F.col(c).isNull() | (F.col(c) == ""))


def distinct_keys(key: str) -> Column:
    """Exact distinct count in which null is one key."""
    return F.count_distinct(F.col(key)) + F.coalesce(F.max(F.col(key).isNull().cast("bigint")), F.lit(0))


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def null_rates(df: DataFrame, columns: Sequence[str] = FIELDS, names: Sequence[str] = FIELDS) -> DataFrame:
    """Percent of null or empty values per column, in one pass."""
    total = F.count(F.lit(1))
    return df.agg(*[percent(_missing(c), total).alias(f"null_rate_{n}") for c, n in zip(columns, names)])


def duplicate_rate(df: DataFrame, key: str = "url") -> DataFrame:
    total = F.count(F.lit(1))
    return df.agg(percent(total - distinct_keys(key), total).alias("duplicate_rate"))


def score_stats(df: DataFrame, score: str = "score") -> DataFrame:
    """Mean, exact median, min and max; 0 where there is no value."""
    median = exact_quantiles(df, score, [0.5]).select(F.col("quantiles")[0]).scalar()
    return df.agg(
        F.avg(score).alias("score_mean"), F.min(score).alias("score_min"), F.max(score).alias("score_max"),
    ).select(
        F.coalesce("score_mean", F.lit(0.0)).alias("score_mean"),
        F.coalesce(median, F.lit(0.0)).alias("score_median"),
        F.coalesce(F.col("score_min").cast("bigint"), F.lit(0)).alias("score_min"),
        F.coalesce(F.col("score_max").cast("bigint"), F.lit(0)).alias("score_max"),
    )


def length_stats(df: DataFrame, text: str = "title") -> DataFrame:
    n = F.length(text)
    return df.agg(
        F.coalesce(F.avg(n), F.lit(0.0)).alias("title_len_mean"),
        F.coalesce(F.min(n).cast("bigint"), F.lit(0)).alias("title_len_min"),
        F.coalesce(F.max(n).cast("bigint"), F.lit(0)).alias("title_len_max"),
    )


def governance_row(
    df: DataFrame,
    source: str,
    columns: Sequence[str] = FIELDS,
    score: str | None = "score",
    length_of: str = "title",
    computed_at: Column | str = "",
) -> DataFrame:
    """All figures of one source from one aggregate; no row for a source without records.

    `columns` are the title, author, text and url columns. Without a score column the
    score figures are 0.
    """
    total = F.count(F.lit(1))
    n = F.length(length_of)
    url = columns[3]
    figures = [
        total.alias("total_records"),
        *[percent(_missing(c), total).alias(f"null_rate_{f}") for c, f in zip(columns, FIELDS)],
        percent(total - distinct_keys(url), total).alias("duplicate_rate"),
        (F.coalesce(F.avg(score), F.lit(0.0)) if score else F.lit(0.0)).alias("score_mean"),
        *[(F.coalesce(f(score).cast("bigint"), F.lit(0)) if score else F.lit(0).cast("bigint")).alias(name)
          for f, name in ((F.min, "score_min"), (F.max, "score_max"))],
        F.coalesce(F.avg(n), F.lit(0.0)).alias("title_len_mean"),
        F.coalesce(F.min(n).cast("bigint"), F.lit(0)).alias("title_len_min"),
        F.coalesce(F.max(n).cast("bigint"), F.lit(0)).alias("title_len_max"),
    ]
    median = F.lit(0.0)
    if score:
        median = F.coalesce(exact_quantiles(df, score, [0.5]).select(F.col("quantiles")[0]).scalar(), F.lit(0.0))
    stamp = F.lit(computed_at) if isinstance(computed_at, str) else computed_at
    return df.agg(*figures).where("total_records > 0").select(
        F.lit(source).alias("source"),
        "total_records",
        *[f"null_rate_{f}" for f in FIELDS],
        "duplicate_rate",
        "score_mean",
        median.alias("score_median"),
        "score_min", "score_max",
        "title_len_mean", "title_len_min", "title_len_max",
        stamp.alias("computed_at"),
    )


def governance_summary(rows: Sequence[DataFrame]) -> DataFrame:
    out = rows[0]
    for other in rows[1:]:
        out = out.unionByName(other)
    return out


# Views of the governance table for its dashboard; the table has one row per source.

def avg_null_rate(governance: DataFrame) -> DataFrame:
    """Mean of the title, author and text rates; the url rate is left out."""
    mean = (F.col("null_rate_title") + F.col("null_rate_author") + F.col("null_rate_text")) / 3
    return governance.select("source", mean.alias("avg_null_rate"))


def null_rates_long(governance: DataFrame) -> DataFrame:
    rates = [f"null_rate_{f}" for f in FIELDS]
    return governance.unpivot("source", rates, "field", "null_rate").withColumn(
        "field", F.replace("field", F.lit("null_rate_"), F.lit("")))


def duplicate_by_source(governance: DataFrame) -> DataFrame:
    return governance.select("source", "duplicate_rate")


def _long(governance: DataFrame, stats: Sequence[tuple[str, str]]) -> DataFrame:
    wide = governance.select("source", *[F.col(c).cast("double").alias(label) for label, c in stats])
    return wide.unpivot("source", [label for label, _ in stats], "stat", "value")


def length_long(governance: DataFrame) -> DataFrame:
    return _long(governance, [("Min", "title_len_min"), ("Mean", "title_len_mean"), ("Max", "title_len_max")])


def score_long(governance: DataFrame, source: str) -> DataFrame:
    return _long(governance.where(F.col("source") == source), [
        ("Min", "score_min"), ("Mean", "score_mean"), ("Median", "score_median"), ("Max", "score_max")])


def kpi_lookup(governance: DataFrame, source: str, metric: str) -> DataFrame:
    return governance.where(F.col("source") == source).select(metric)


# Column profiles.

def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("bigint"))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count, null_percent) for every column; the empty string is a value."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    return counts.unpivot("_total", list(df.columns), "column", "null_count").select(
        "column", "null_count", percent(F.col("null_count"), F.col("_total")).alias("null_percent"))


def describe_lengths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of text lengths, a row per column."""
    lengths = df.select(*[F.length(c).cast("bigint").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "n")
    basic = lengths.groupBy("column").agg(
        F.count("n").alias("count"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"),
        F.min("n").alias("min"), F.max("n").alias("max"))
    quartiles = exact_quantiles(lengths, "n", [0.25, 0.5, 0.75], by=["column"])
    q = F.col("quantiles")
    return basic.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min",
        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "max")


def iqr_report(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """Quartiles, two-sided bounds, outlier count and percent; NaN counts as a row, not as an outlier."""
    q = F.col("quantiles")
    bounds = exact_quantiles(df, value, [0.25, 0.75]).select(
        F.struct(q[0].alias("q1"), q[1].alias("q3"),
                 (q[0] - k * (q[1] - q[0])).alias("lower"), (q[1] + k * (q[1] - q[0])).alias("upper")))
    b = F.col("_b")
    return (
        df.select(F.col(value).alias("_x")).withColumn("_b", bounds.scalar())
        .agg(
            F.count(F.lit(1)).alias("_total"),
            F.count_if(~F.isnan(F.col("_x").cast("double")) & (
                (F.col("_x") < b["lower"]) | (F.col("_x") > b["upper"]))).alias("outliers"),
            F.max("_b").alias("_b"),
        )
        .select(b["q1"].alias("q1"), b["q3"].alias("q3"), (b["q3"] - b["q1"]).alias("iqr"),
                b["lower"].alias("lower"), b["upper"].alias("upper"), "outliers",
                percent(F.col("outliers"), F.col("_total")).alias("outlier_percent"))
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """(bin, lower, upper, n): equal-width bins over [min, max], the last one closed.

    Equal minimum and maximum widen to one unit around the value. Empty bins are kept. Null
    and NaN are in no bin.
    """
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    spread = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    counts = (
        df.where(x.isNotNull()).select(x.alias("_x"))
        .withColumn("_s", spread.select(F.struct("lo", "hi")).scalar())
        .select(F.least(F.width_bucket("_x", F.col("_s.lo"), F.col("_s.hi"), F.lit(bins)), F.lit(bins))
                .cast("bigint").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    edges = spread.where("lo is not null").select(
        "lo", "hi", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin")).select(
        "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
        F.when(F.col("bin") == bins, F.col("hi")).otherwise(F.col("lo") + F.col("bin") * width).alias("upper"))
    return edges.join(counts, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def date_range(df: DataFrame, date: str) -> DataFrame:
    return df.agg(F.min(date).alias("first"), F.max(date).alias("last"))


def duplicate_report(df: DataFrame, key: str = "url") -> DataFrame:
    """Rows that repeat an earlier key, and their percent."""
    total = F.count(F.lit(1))
    repeats = total - distinct_keys(key)
    return df.agg(repeats.alias("duplicates"), percent(repeats, total).alias("duplicate_percent"))
