"""What posts and articles differ in, for the plans that treat both alike."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tertulia.functions.wordlists import STOPWORDS
from tertulia.operators import silver
from tertulia.sources import json_batches


@dataclass(frozen=True)
class Kind:
    name: str
    schema: StructType
    #: The first record of each value of these, as they were read, is kept.
    keys: Sequence[str]
    coerce: Callable[[DataFrame], DataFrame]
    defaults: Mapping[str, str]
    stripped: Sequence[str]
    cleaned: Sequence[str]
    min_chars: Mapping[str, int]
    columns: Sequence[str]
    #: The column whose upper outliers are dropped, if any.
    fenced: str | None = None

    def key(self) -> Column:
        """One string of fixed length for the keys; nulls are a value of their own."""
        return F.concat_ws("-", *(F.coalesce(F.md5(F.col(c)), F.lit("none")) for c in self.keys))

    def typed(self, raw: DataFrame, keep: Sequence[str] = (), stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
        """The steps that look at one record: types, defaults, blanks, cleaned texts. They give
        the same rows before the first of each key is picked and after."""
        filled = silver.strip_columns(silver.fill_defaults(self.coerce(raw), self.defaults), self.stripped)
        return silver.add_clean(filled, self.cleaned, stopwords).select(*self.columns, *keep)

    def silver(self, first: DataFrame) -> DataFrame:
        """The silver table of the first typed record of each key."""
        valid = silver.min_length_filters(first, self.min_chars)
        return silver.select_silver(silver.iqr_upper_fence(valid, self.fenced) if self.fenced else valid, self.columns)


POSTS = Kind(
    "posts", json_batches.POSTS, ("url", "title"), silver.coerce_posts, silver.POST_DEFAULTS, ("title",), ("title", "text"),
    silver.POST_MIN_CHARS, silver.POST_COLUMNS, "score")
ARTICLES = Kind(
    "articles", json_batches.ARTICLES, ("url",), silver.coerce_articles, silver.ARTICLE_DEFAULTS, ("titulo",),
    ("titulo", "contenido", "extracto"), silver.ARTICLE_MIN_CHARS, silver.ARTICLE_COLUMNS)
