"""Lexicon sentiment as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.functions.text import SPACES
from tertulia.functions.wordlists import NEGATIVE, POSITIVE

THRESHOLD = 0.1


def _hits(words: str, lexicon: list[str]) -> Column:
    if not lexicon:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.col(words), lambda w: w.isin(lexicon))), F.lit(0))


def with_sentiment(
    df: DataFrame,
    text: str = "text",
    positive: Iterable[str] = POSITIVE,
    negative: Iterable[str] = NEGATIVE,
    threshold: float = THRESHOLD,
    separator: str = SPACES,
) -> DataFrame:
    """Add `sentiment` (label, from the unrounded ratio) and `polarity` (FLOAT, 4 decimals).

    Text is split once and narrowed to lexicon words once; both counts read that
    short array.
    """
    pos, neg = sorted(set(positive)), sorted(set(negative))
    both = sorted({*pos, *neg})
    known = F.filter(F.split(F.lower(F.col(text)), separator), lambda w: w.isin(both)) if both else F.array()
    scored = (
        df.withColumn("_known", known)
        .withColumn("_pos", _hits("_known", pos))
        .withColumn("_neg", _hits("_known", neg))
        .withColumn(
            "_ratio",
            F.when(F.col("_pos") + F.col("_neg") > 0,
                   (F.col("_pos") - F.col("_neg")) / (F.col("_pos") + F.col("_neg"))).otherwise(0.0),
        )
    )
    label = (
        F.when(F.col("_ratio") > threshold, "positive")
        .when(F.col("_ratio") < -threshold, "negative")
        .otherwise("neutral")
    )
    # A generated row: a filter on the label stays above it, where Spark would else put the whole
    # expression, the cleaning of the text included, into the filter once for each time the label names it.
    polarity = F.bround("_ratio", 4).cast("float")
    return scored.select(*df.columns, F.inline(F.array(F.struct(label.alias("sentiment"), polarity.alias("polarity")))))
