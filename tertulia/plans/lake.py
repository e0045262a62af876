"""The three refresh steps over a lake folder: bronze files, silver and gold snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tertulia.functions.wordlists import NEGATIVE, POSITIVE, STOPWORDS
from tertulia.plans import gold, silver
from tertulia.sources import json_batches
from tertulia.sources.snapshots import read_latest_run, read_snapshots, write_snapshot


def refresh_silver(
    spark: SparkSession,
    bronze: str,
    path: str,
    run_ts: str,
    posts_glob: str = "posts_*.json",
    articles_glob: str = "articles_*.json",
    lines: bool = False,
    stopwords: Iterable[str] = STOPWORDS,
) -> dict[str, str]:
    """Clean every bronze file into one silver snapshot per source; a source without
    records writes none."""
    plans = {
        "posts": (posts_glob, json_batches.POSTS, silver.process_posts),
        "articles": (articles_glob, json_batches.ARTICLES, silver.process_articles),
    }
    out = {}
    for name, (glob, schema, process) in plans.items():
        raw = json_batches.read_json_batches(spark, bronze, glob, schema, lines)
        if not raw.isEmpty():
            out[name] = f"{path}/{name}"
            write_snapshot(process(raw, stopwords), out[name], run_ts)
    return out


def silver_table(spark: SparkSession, path: str, all_runs: bool = False) -> DataFrame | None:
    """The newest silver run, or all of them; None where nothing was written.

    Every run rereads all bronze files, so reading all runs multiplies the records.
    """
    try:
        return read_snapshots(spark, path) if all_runs else read_latest_run(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def refresh_gold(
    spark: SparkSession,
    silver_path: str,
    path: str,
    run_ts: str,
    all_runs: bool = True,
    posts_source: str = "posts",
    articles_source: str = "articles",
    positive: Iterable[str] = POSITIVE,
    negative: Iterable[str] = NEGATIVE,
) -> dict[str, str]:
    """The governance table and the seven marts; nothing without silver data.

    Both cover all silver runs, as every run is measured; `all_runs=False` takes the newest."""
    posts = silver_table(spark, f"{silver_path}/posts", all_runs)
    articles = silver_table(spark, f"{silver_path}/articles", all_runs)
    if posts is None and articles is None:
        return {}
    sources = {}
    if posts is not None:
        sources[posts_source] = {"df": posts}
    if articles is not None:
        sources[articles_source] = {
            "df": articles, "columns": ("titulo", "autor", "contenido", "url"), "score": None, "length_of": "contenido"}
    target = f"{path}/governance"
    write_snapshot(gold.governance(sources, run_ts), target, run_ts)
    corpus = gold.scored_corpus(
        posts, articles, positive, negative, posts_source, articles_source,
        order=("source", "run_ts", "source_file", "day", "title", "author", "score", "text"), keep=["run_ts", "source_file"])
    return {"governance": target, **gold.write_marts(spark, corpus, path, run_ts, posts_source)}
