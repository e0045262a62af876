"""The marts kept up by what a run brings.

A scored corpus is held in hash buckets of the url (`sources.buckets`). A run scores its new
silver rows, merges them, and writes fact deltas: the sums of the rows that come first now, less
those of the rows that they take the place of. The marts are sums over the deltas of all
committed runs, so an old silver table is never read again, nor a text that stays.

Sums are whole numbers or decimals (a polarity has four places), so that what is taken back is
taken back exactly. A group whose rows are all gone has a count of 0 and is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tertulia.functions.sentiment import with_sentiment
from tertulia.functions.wordlists import NEGATIVE, POSITIVE
from tertulia.operators import marts
from tertulia.plans import gold
from tertulia.sources import buckets, runs

#: The columns that each fact table is grouped by, and its sums.
FACTS: Mapping[str, tuple[Sequence[str], Sequence[str]]] = {
    "daily": (("source", "day", "sentiment"), ("n", "score_sum", "score_n", "polarity_sum", "polarity_n")),
    "words": (("word", "sentiment", "source"), ("n",)),
    "authors": (("author", "source"), ("n",)),
}
TYPES = {"day": "date", "polarity_sum": "decimal(38,4)", "n": "long", "score_sum": "long", "score_n": "long", "polarity_n": "long"}
ORDER = ("source", "day", "title", "author", "score", "text")


def _facts(name: str, corpus: DataFrame) -> DataFrame:
    if name == "words":
        return marts.word_facts(corpus)
    by, _ = FACTS[name]
    exact = F.col("polarity").cast("decimal(9,4)")
    sums = [F.count(F.lit(1)).alias("n")]
    if name == "daily":
        sums += [F.sum("score").alias("score_sum"), F.count("score").alias("score_n"), F.sum(exact).alias("polarity_sum"), F.count("polarity").alias("polarity_n")]
    return corpus.groupBy(*by).agg(*sums)


def _schema(name: str) -> str:
    by, sums = FACTS[name]
    return ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in (*by, *sums, "run"))


def _delta(name: str, done: buckets.Merge) -> DataFrame:
    by, sums = FACTS[name]
    less = _facts(name, done.replaced)
    less = less.select(*by, *((-F.col(c)).alias(c) for c in sums))
    both = _facts(name, done.winners).select(*by, *sums).unionByName(less)
    return both.groupBy(*by).agg(*(F.sum(c).cast(TYPES[c]).alias(c) for c in sums))


def _long(order: Sequence[str]) -> list[str]:
    """The order from its first long text on."""
    return list(order[min((order.index(c) for c in ("title", "text") if c in order), default=len(order)):])


def refresh(
    spark: SparkSession, new: DataFrame, path: str, run: str, order: Sequence[str] = ORDER, positive: Iterable[str] = POSITIVE,
    negative: Iterable[str] = NEGATIVE, n_buckets: int = buckets.BUCKETS,
) -> buckets.Merge:
    """Take in the corpus rows (url, title, text, author, day, score, source and what `order`
    names) of a run. Of a url the first in `order` over all runs counts; null urls are one url."""
    if buckets.is_committed(spark, path, run):
        raise ValueError(f"{run} is committed already")
    scored = with_sentiment(new.withColumn("key", F.coalesce(F.md5("url"), F.lit("none"))), "text", positive, negative, separator=" ")
    done = buckets.merge(path, run, scored, "key", order, n_buckets, _long(order))
    for name in FACTS:
        _delta(name, done).withColumn("run", F.lit(run)).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/facts_{name}/{run}")
    buckets.commit(spark, path, run, done)
    return done


def facts(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A fact table as the committed runs make it up."""
    by, sums = FACTS[name]
    try:
        deltas = spark.read.schema(_schema(name)).option("recursiveFileLookup", True).parquet(f"{path}/facts_{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        deltas = spark.createDataFrame([], _schema(name))
    done = runs.committed(spark, f"{path}/buckets").select("run")
    counted = deltas.join(done, "run", "left_semi").select(*by, *sums)
    if name == "words":  # one shuffle for the marts by word, sentiment and source and by word and source
        counted = counted.repartition("word", "source")
    return counted.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums)).where("n <> 0")


def read_marts(spark: SparkSession, path: str, score_source: str = "posts") -> dict[str, DataFrame]:
    """The seven marts over everything that was taken in."""
    return gold.build_marts(facts(spark, path, "authors"), facts(spark, path, "daily"), facts(spark, path, "words"), score_source)
