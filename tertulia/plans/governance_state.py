"""Governance figures of all runs from what each run left, without its rows.

A run leaves of each source one row of counts and sums, which add up exactly, its distinct urls
and how often each of its scores occurs. Figures over any set of runs are made from these alone,
and are those of `plans.gold.governance`, which reads all rows: a url that several runs hold counts
once, and the median is that of all scores together.

    run=<run>/           a row for each source; committed last, so that a run is there as a whole
    _urls/run=<run>/     source, url
    _scores/run=<run>/   source, score, n
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tertulia.operators.quality import FIELDS, distinct_keys, percent
from tertulia.operators.quantiles import exact_quantiles
from tertulia.sources import runs
from tertulia.sources.shared import written

#: Urls were estimated by sketches of 2 ** LG_URLS entries; they are counted now. Tests read it.
LG_URLS = 14

URLS = StructType().add("source", "string").add("url", "string")
SCORES = StructType().add("source", "string").add("score", "double").add("n", "long")


@dataclass(frozen=True)
class State:
    """What a run leaves of one source: a row of counts and sums, urls, scores with counts."""

    row: DataFrame
    urls: DataFrame
    scores: DataFrame


def _missing(c: str) -> Column:
    return F.count_if(F.col(c).isNull() | (F.col(c) == ""))


def _ends() -> list[Column]:
    """Least and most of the figures that have them."""
    return [f(c).alias(c) for f, c in ((F.min, "score_min"), (F.max, "score_max"), (F.min, "length_min"), (F.max, "length_max"))]


def state_row(
    df: DataFrame, source: str, columns: Sequence[str] = FIELDS, score: str | None = "score", length_of: str = "title"
) -> State:
    """What a run leaves of one source; nothing of an empty one. `columns` are the title, author,
    text and url columns. The rows are read once, for what is summed of each url and score."""
    n, named = F.length(length_of).cast("bigint"), F.lit(source).alias("source")
    values = F.col(score).cast("double") if score else F.lit(None).cast("double")
    whole = F.col(score).cast("bigint") if score else F.lit(None).cast("bigint")
    missing = [f"missing_{f}" for f in FIELDS]
    facts = written(df.groupBy(F.col(columns[3]).cast("string").alias("url"), values.alias("score")).agg(
        F.count(F.lit(1)).alias("total"), *(_missing(c).alias(m) for c, m in zip(columns, missing)),
        F.count(values).alias("score_n"), F.sum(values).alias("score_sum"), F.min(whole).alias("score_min"), F.max(whole).alias("score_max"),
        F.count(n).alias("length_n"), F.sum(n).alias("length_sum"), F.min(n).alias("length_min"), F.max(n).alias("length_max")), "facts")
    row = facts.agg(named, *(F.sum(c).alias(c) for c in ("total", *missing, "score_n", "score_sum", "length_n", "length_sum")), *_ends()).where("total > 0")
    # A null url is one url, as it is in the count over all rows.
    urls = facts.select("url").distinct()
    scores = facts.where("score IS NOT NULL").groupBy("score").agg(F.sum("total").alias("n"))
    return State(row, urls.select(named, "url"), scores.select(named, "score", "n"))


def add_run(states: Sequence[State], path: str, run: str) -> None:
    """Write and commit the state of a run."""
    runs.withdraw(states[0].row.sparkSession, path, run)
    for name in ("urls", "scores", "row"):
        out = reduce(DataFrame.unionByName, (getattr(s, name) for s in states))
        runs.write_run(out.coalesce(1) if name == "row" else out, path if name == "row" else f"{path}/_{name}", run)


def governance(spark: SparkSession, path: str, computed_at: str, of: Sequence[str] | None = None) -> DataFrame:
    """The governance table over the committed runs (`of` names some of them)."""
    names = sorted(r.run for r in runs.committed(spark, path).select("run").collect()) if of is None else list(of)
    if not names:
        raise ValueError("no committed run")
    state = runs.read_runs(spark, path, names)
    total, zero = F.col("total"), F.lit(0).cast("bigint")
    sums = state.groupBy("source").agg(
        *(F.sum(c).alias(c) for c in ("total", *(f"missing_{f}" for f in FIELDS), "score_n", "score_sum", "length_n", "length_sum")),
        *_ends())
    urls = runs.read_runs(spark, f"{path}/_urls", names, URLS).groupBy("source").agg(distinct_keys("url").alias("urls"))
    scores = runs.read_runs(spark, f"{path}/_scores", names, SCORES)
    medians = exact_quantiles(scores, "score", [0.5], ["source"], weight="n").select("source", F.col("quantiles")[0].alias("median"))
    return sums.join(urls, "source").join(medians, "source", "left").select(
        "source", total.alias("total_records"), *(percent(F.col(f"missing_{f}"), total).alias(f"null_rate_{f}") for f in FIELDS),
        percent(total - F.col("urls"), total).alias("duplicate_rate"),
        F.coalesce(F.try_divide("score_sum", "score_n"), F.lit(0.0)).alias("score_mean"), F.coalesce("median", F.lit(0.0)).alias("score_median"),
        F.coalesce("score_min", zero).alias("score_min"), F.coalesce("score_max", zero).alias("score_max"),
        F.coalesce(F.try_divide("length_sum", "length_n"), F.lit(0.0)).alias("title_len_mean"),
        F.coalesce("length_min", zero).alias("title_len_min"), F.coalesce("length_max", zero).alias("title_len_max"),
        F.lit(computed_at).alias("computed_at"))
