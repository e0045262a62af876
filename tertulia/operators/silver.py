"""Silver: typed, filled, filtered and cleaned records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tertulia.functions.dates import epoch_to_ts, iso_to_utc, to_score
from tertulia.functions.text import clean_text, strip
from tertulia.functions.wordlists import STOPWORDS
from tertulia.operators.quantiles import exact_quantiles

POST_DEFAULTS = {"title": "", "text": "", "author": "unknown", "source_file": ""}
ARTICLE_DEFAULTS = {
    "titulo": "", "autor": "Desconocido", "extracto": "", "contenido": "", "etiquetas": "", "source_file": "",
}
POST_MIN_CHARS = {"title": 3, "url": 5, "text": 10}
ARTICLE_MIN_CHARS = {"titulo": 3, "url": 5, "contenido": 50}
POST_COLUMNS = ("title", "title_clean", "text", "text_clean", "author", "date", "score", "url", "source_file")
ARTICLE_COLUMNS = (
    "titulo", "titulo_clean", "autor", "fecha", "extracto", "extracto_clean",
    "contenido", "contenido_clean", "etiquetas", "url", "fuente", "source_file",
)


def coerce_posts(posts: DataFrame, date: str = "date", score: str = "score") -> DataFrame:
    """Epoch seconds to timestamp, score to whole number; bad values become null and 0."""
    return posts.withColumns({date: epoch_to_ts(date), score: to_score(score)})


def coerce_articles(articles: DataFrame, date: str = "fecha") -> DataFrame:
    return articles.withColumn(date, iso_to_utc(date))


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Nulls only; an empty string stays empty."""
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip(c) for c in columns})


def long_enough(minimums: Mapping[str, int]) -> Column:
    """True where every listed column is longer than its minimum; null or false otherwise."""
    return reduce(Column.__and__, [F.length(c) > chars for c, chars in minimums.items()])


def min_length_filters(df: DataFrame, minimums: Mapping[str, int]) -> DataFrame:
    return df.where(long_enough(minimums))


def upper_fence(df: DataFrame, value: str = "score", k: float = 1.5) -> DataFrame:
    """One row: `fence` = Q3 + k·IQR."""
    q = F.col("quantiles")
    return exact_quantiles(df, value, [0.25, 0.75]).select((q[1] + k * (q[1] - q[0])).alias("fence"))


def iqr_upper_fence(df: DataFrame, value: str = "score", k: float = 1.5) -> DataFrame:
    """Drop rows above the upper fence; the fence reaches the scan side as one scalar."""
    return df.where(F.col(value) <= upper_fence(df, value, k).scalar())


def add_clean(df: DataFrame, columns: Sequence[str], stopwords=STOPWORDS) -> DataFrame:
    """Add `<column>_clean` for each column."""
    return df.withColumns({f"{c}_clean": clean_text(c, stopwords) for c in columns})


def select_silver(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def observe_rows(df: DataFrame, observation: Observation) -> DataFrame:
    """Report the row count of a stage with no extra pass, for progress only.

    A stage rerun after a lost executor can be counted twice; `stage_counts` cannot.
    """
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(stage, rows) for each named stage. Counting needs few columns, so each scan is narrow."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, df in stages.items()
    ]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out
