"""Marts from the deltas of runs against a rebuild from all silver rows."""

import datetime as dt
import random

import pytest

from tertulia.functions.sentiment import with_sentiment
from tertulia.operators import marts
from tertulia.operators.dedup import keep_first
from tertulia.plans import gold, incremental_marts
from tertulia.sources import buckets

SCHEMA = "url string, title string, text string, author string, day date, score long, source string"
WORDS = ["bueno", "malo", "plaza", "calle", "reforma", "crisis"]


def arrivals(seed=3):
    """Runs whose urls come again, earlier and later in order, with other words, days and authors."""
    r = random.Random(seed)
    row = lambda: (r.choice([f"u{k}" for k in range(60)] + [None]), f"t{r.randrange(4)}", " ".join(r.choice(WORDS) for _ in range(r.randrange(9))),
                   r.choice(["ana", "luz", None]), r.choice([None, *(dt.date(2026, 1, d) for d in range(1, 9))]), r.choice([None, *range(-3, 9)]), r.choice(["posts", "news"]))
    return [[row() for _ in range(n)] for n in (40, 70, 3, 0, 50)]


def rows(mart):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in mart.collect()), key=str)


def test_every_run_equals_a_rebuild(spark, tmp_path):
    path, seen = str(tmp_path / "marts"), []
    for k, new in enumerate(arrivals()):
        seen += new
        df = spark.createDataFrame(new, SCHEMA)
        done = incremental_marts.refresh(spark, df, path, f"run{k}", positive=["bueno"], negative=["malo"], n_buckets=8)
        assert len(done.changed) <= min(8, len(new))
        corpus = with_sentiment(keep_first(spark.createDataFrame(seen, SCHEMA), ["url"], incremental_marts.ORDER), "text", ["bueno"], ["malo"], separator=" ")
        full = gold.build_marts(corpus, marts.daily_facts(corpus), marts.word_facts(corpus), "posts")
        kept = incremental_marts.read_marts(spark, path)
        assert {name: rows(mart) for name, mart in kept.items()} == {name: rows(mart) for name, mart in full.items()}
    with pytest.raises(ValueError, match="committed already"):
        incremental_marts.refresh(spark, df, path, "run4")


def test_a_run_reads_its_rows_and_touched_buckets_only(spark, tmp_path):
    path, silver = str(tmp_path / "marts"), str(tmp_path / "silver")
    first, second = arrivals()[0], arrivals()[2]
    spark.createDataFrame(first, SCHEMA).write.parquet(f"{silver}/a")
    spark.createDataFrame(second, SCHEMA).write.parquet(f"{silver}/b")
    incremental_marts.refresh(spark, spark.read.parquet(f"{silver}/a"), path, "run0", n_buckets=64)
    before = buckets.owners(spark, path)
    done = incremental_marts.refresh(spark, spark.read.parquet(f"{silver}/b"), path, "run1", n_buckets=64)
    assert 0 < len(done.changed) <= 3 < len(before)
    assert not any("/silver/a" in f for f in done.replaced.inputFiles())
    assert {b for b, run in done.owners.items() if run == "run0"} == set(before) - set(done.changed)
    for mart in incremental_marts.read_marts(spark, path).values():
        assert all("/facts_" in f or "/_runs/" in f for f in mart.inputFiles())


def test_a_failed_run_leaves_the_marts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "marts")
    assert all(m.isEmpty() for m in incremental_marts.read_marts(spark, path).values())
    one, two = (spark.createDataFrame(a, SCHEMA) for a in arrivals()[:2])
    incremental_marts.refresh(spark, one, path, "run0", n_buckets=8)
    before = {name: rows(mart) for name, mart in incremental_marts.read_marts(spark, path).items()}

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(buckets, "commit", fail)
        with pytest.raises(RuntimeError):
            incremental_marts.refresh(spark, two, path, "run1", n_buckets=8)
    assert {name: rows(mart) for name, mart in incremental_marts.read_marts(spark, path).items()} == before
