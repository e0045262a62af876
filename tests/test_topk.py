"""Threshold top-k against a full count, ties and bounds included."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tertulia.operators import topk
from tertulia.sources.shared import written


def full(df, by, n):
    return [tuple(r) for r in df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *by).limit(n).collect()]


def got(df, by, n):
    return [tuple(r) for r in topk.top_counts(df, by, n).collect()]


@pytest.mark.parametrize("n", [1, 10, 50, 5000])
def test_equals_a_full_count(spark, n):
    r = random.Random(n)
    words = [(f"w{int(r.paretovariate(0.6)) % 3000}", r.choice(["a", "b", None])) for _ in range(20_000)] + [(None, "a")] * 30
    df = spark.createDataFrame(words, "word string, source string").repartition(9)
    assert got(df, ["word", "source"], n) == full(df, ["word", "source"], n)


def test_ties_and_words_spread_thinly(spark):
    """A word that is in no task's own list may be the most frequent of all."""
    rows = [(p, f"local {p}") for p in range(8) for _ in range(6)] + [(p, "everywhere") for p in range(8) for _ in range(5)]
    rows += [(p, f"tied {k}") for p in range(8) for k in range(12)]
    df = spark.createDataFrame(rows, "p int, word string").repartitionByRange(8, "p")
    for n in (1, 2, 9, 12, 15, 21):
        assert got(df, ["word"], n) == full(df, ["word"], n)


def test_the_vocabulary_is_not_shuffled(spark):
    r = random.Random(1)
    words = [(f"rare {k}",) for k in range(30_000)] + [(f"common {min(int(r.expovariate(0.1)), 80)}",) for _ in range(20_000)]
    r.shuffle(words)
    df = spark.createDataFrame(words, "word string").repartition(6)
    local = written(topk.local_counts(df, ["word"]), "local")
    left = topk.candidates(local, ["word"], 10)
    tasks = local.select("task").distinct().count()
    assert tasks == 6 and local.where("place <= 10").count() == 60
    assert left.count() < 40 and local.count() > 30_000
    assert got(df, ["word"], 10) == full(df, ["word"], 10)


def test_small_and_empty(spark, monkeypatch):
    monkeypatch.setattr(topk, "FOLD_ROWS", 2)
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "word string")
    assert got(df, ["word"], 2) == [("a", 2), ("b", 2)] and got(df, ["word"], 9)[2:] == [(None, 1), ("c", 1)]
    assert got(df.limit(0), ["word"], 3) == []


def test_sums_are_not_taken_again_for_every_batch(monkeypatch):
    """With more groups in a task than FOLD_ROWS, the rows summed up stay in proportion to those that came."""
    summed, fold = [], topk._folded
    monkeypatch.setattr(topk, "_folded", lambda parts, by: summed.append(sum(map(len, parts))) or fold(parts, by))
    batches = (pa.table({"word": [f"w{k}" for k in range(b * 10, b * 10 + 10)] + ["all"]}) for b in range(400))
    found = topk.gathered(batches, ["word"], 50)
    assert sum(summed) < 4 * 4400 and len(found) == 4001
    assert {r["word"]: r["n"] for r in found.to_pylist() if r["n"] > 1} == {"all": 400}


def test_words_of_texts(spark):
    r = random.Random(3)
    texts = [(" ".join(r.choice(["", "añoñ", "año", "long", "words here", "x" * 70]) for _ in range(r.randint(0, 30))), r.choice(["a", None])) for _ in range(3000)]
    df = spark.createDataFrame([*texts, (None, "a")], "word string, source string").repartition(5)
    words = df.select(F.explode(F.split("word", " ")).alias("word"), "source").where(F.length("word") >= 4)
    found = topk.top_counts(df, ["word", "source"], 7, words="word", min_chars=4)
    assert [tuple(r) for r in found.collect()] == full(words, ["word", "source"], 7)
