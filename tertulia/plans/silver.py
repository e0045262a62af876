"""Bronze records to silver tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.functions.dates import to_score
from tertulia.functions.wordlists import STOPWORDS
from tertulia.operators import silver
from tertulia.operators.dedup import keep_first


def valid_posts(
    raw: DataFrame,
    keys: Sequence[str] = ("url", "title"),
    order: Sequence[str] = ("source_file", "pos"),
    min_chars: Mapping[str, int] = silver.POST_MIN_CHARS,
) -> DataFrame:
    """First record per key, typed, filled, stripped and long enough; before the fence."""
    first = keep_first(raw, keys, order)
    filled = silver.fill_defaults(silver.coerce_posts(first), silver.POST_DEFAULTS)
    return silver.min_length_filters(silver.strip_columns(filled, ["title"]), min_chars)


def _narrow(
    raw: DataFrame, keys: Sequence[str], order: Sequence[str], min_chars: Mapping[str, int], copies: str | None = None
) -> DataFrame:
    """The first record per key without its text, of which only the length is shuffled: its
    typed `score`, and `valid`, whether `valid_posts` has it."""
    columns = raw.select(*dict.fromkeys([*keys, *order, "url", "title"]), "score", F.length("text").alias("_chars"))
    first = keep_first(columns, keys, order, copies)
    rows = silver.strip_columns(first.fillna("", ["title"]), ["title"]).withColumn("score", to_score("score"))
    short = {c: n for c, n in min_chars.items() if c != "text"}
    valid = F.coalesce("_chars", F.lit(0)) > min_chars["text"] if "text" in min_chars else F.lit(True)
    return rows.withColumn("valid", silver.long_enough(short) & valid if short else valid)


def valid_scores(
    raw: DataFrame,
    keys: Sequence[str] = ("url", "title"),
    order: Sequence[str] = ("source_file", "pos"),
    min_chars: Mapping[str, int] = silver.POST_MIN_CHARS,
) -> DataFrame:
    """The scores of `valid_posts`, from a dedupe of narrow rows."""
    return _narrow(raw, keys, order, min_chars).where("valid").select("score")


def fenced_posts(
    raw: DataFrame,
    keys: Sequence[str] = ("url", "title"),
    order: Sequence[str] = ("source_file", "pos"),
    min_chars: Mapping[str, int] = silver.POST_MIN_CHARS,
) -> DataFrame:
    """Valid posts up to the upper fence. The fence needs scores only, so whole rows are
    shuffled once, for the rows that stay, and never for the fence."""
    fence = silver.upper_fence(valid_scores(raw, keys, order, min_chars)).scalar()
    return valid_posts(raw, keys, order, min_chars).where(F.col("score") <= fence)


def process_posts(
    raw: DataFrame,
    stopwords: Iterable[str] = STOPWORDS,
    keys: Sequence[str] = ("url", "title"),
    order: Sequence[str] = ("source_file", "pos"),
    min_chars: Mapping[str, int] = silver.POST_MIN_CHARS,
) -> DataFrame:
    """Silver posts. Text is cleaned last, on the rows that remain."""
    kept = fenced_posts(raw, keys, order, min_chars)
    return silver.select_silver(silver.add_clean(kept, ["title", "text"], stopwords), silver.POST_COLUMNS)


def post_stage_counts(
    raw: DataFrame, keys: Sequence[str] = ("url", "title"), order: Sequence[str] = ("source_file", "pos")
) -> DataFrame:
    """(stage, rows) after each cleaning stage of `process_posts`, from one narrow dedupe.

    The dedupe counts the copies it drops, and the later stages are conditions on its
    rows, so no stage reads the table again.
    """
    rows = _narrow(raw, keys, order, silver.POST_MIN_CHARS, copies="_copies")
    # A plain filter would move below the dedupe, and a branch without `_copies` would drop
    # the count; either way the fence could no longer share the dedupe's shuffle.
    scores = rows.select(F.when(F.col("valid") & (F.col("_copies") > 0), F.col("score")).alias("score"))
    fence = silver.upper_fence(scores).scalar()
    counts = rows.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw"), F.count(F.lit(1)).alias("deduplicated"),
        F.count_if("valid").alias("valid"), F.count_if(F.col("valid") & (F.col("score") <= fence)).alias("kept"))
    return counts.unpivot([], counts.columns, "stage", "rows")


def process_articles(
    raw: DataFrame,
    stopwords: Iterable[str] = STOPWORDS,
    keys: Sequence[str] = ("url",),
    order: Sequence[str] = ("source_file", "pos"),
    min_chars: Mapping[str, int] = silver.ARTICLE_MIN_CHARS,
) -> DataFrame:
    """Silver articles; they have no score and so no fence."""
    first = keep_first(raw, keys, order)
    filled = silver.fill_defaults(silver.coerce_articles(first), silver.ARTICLE_DEFAULTS)
    kept = silver.min_length_filters(silver.strip_columns(filled, ["titulo"]), min_chars)
    cleaned = silver.add_clean(kept, ["titulo", "contenido", "extracto"], stopwords)
    return silver.select_silver(cleaned, silver.ARTICLE_COLUMNS)
