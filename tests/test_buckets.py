"""Merges into hash buckets, against a plain pick of the first rows."""

import random

import pytest
from pyspark.sql import functions as F

from tertulia.sources import buckets

SCHEMA = "key string, a long, b string, text string"
ORDER = ("a", "b")


def batch(r, n, keys):
    out = []
    for _ in range(n):
        key, a, b = f"k{r.randrange(keys)}", r.choice([None, 1, 2]), r.choice([None, "", "x", "y"])
        out.append((key, a, b, f"{key} {a} {b}"))
    return out


def place(row):
    return tuple((v is not None, v or 0 if i == 0 else v or "") for i, v in enumerate(row[1:3]))


def found(df):
    return sorted((tuple(r) for r in df.select("key", "a", "b", "text").collect()), key=str)


@pytest.mark.parametrize("long", [(), ("b",), ("a", "b")])
def test_merges_equal_a_plain_pick(spark, tmp_path, monkeypatch, long):
    monkeypatch.setattr(buckets, "HOT", 2)
    r, path, table = random.Random(5), str(tmp_path / "table"), {}
    for k, (n, keys) in enumerate([(60, 12), (0, 1), (25, 20), (4, 30)]):
        new, came, gone = batch(r, n, keys), {}, {}
        for row in sorted(new, key=place, reverse=True):
            if row[0] not in table or place(row) < place(table[row[0]]):
                came[row[0]] = row
        gone = {key: table[key] for key in came if key in table}
        done = buckets.merge(path, f"run{k}", spark.createDataFrame(new, SCHEMA), "key", ORDER, 8, long)
        assert found(done.winners) == sorted(came.values(), key=str) and found(done.replaced) == sorted(gone.values(), key=str)
        buckets.commit(spark, path, f"run{k}", done)
        table |= came
        held = buckets.owners(spark, path)
        assert {b for b, run in held.items() if run == f"run{k}"} == set(done.changed)
        if held:
            assert buckets.read(spark, path, held).columns == ["key", "a", "b", "text"]
            assert found(buckets.read(spark, path, held)) == sorted(table.values(), key=str)


def test_whole_rows_are_written_to_their_bucket_alone(spark, tmp_path, monkeypatch):
    path, beside, write = str(tmp_path / "table"), [], buckets.written
    monkeypatch.setattr(buckets, "written", lambda df, *a, **k: beside.append(df.columns) or write(df, *a, **k))
    for k, a in enumerate((2, 1)):
        rows = spark.createDataFrame([(f"k{n}", a, "x", "a long text") for n in range(9)], SCHEMA)
        buckets.commit(spark, path, f"run{k}", buckets.merge(path, f"run{k}", rows, "key", ORDER, 4))
    assert beside and not any("text" in columns for columns in beside)


def test_buckets_written_without_marks_are_read_and_merged(spark, tmp_path):
    path = str(tmp_path / "table")
    old = spark.createDataFrame([(f"k{n}", 5, "x", f"old {n}") for n in range(12)], SCHEMA)
    old = old.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(4)).cast("int"))
    old.write.partitionBy("bucket").parquet(f"{path}/rows/run0")
    held = {r.bucket: "run0" for r in old.select("bucket").distinct().collect()}
    buckets.commit(spark, path, "run0", buckets.Merge(old, old, sorted(held), held))
    assert found(buckets.read(spark, path, held)) == found(old)
    new = spark.createDataFrame([("k3", 4, "x", "new 3"), ("k4", 6, "x", "later"), ("k99", 1, "x", "new 99")], SCHEMA)
    done = buckets.merge(path, "run1", new, "key", ORDER, 4)
    buckets.commit(spark, path, "run1", done)
    assert [r.text for r in done.replaced.collect()] == ["old 3"]
    texts = {r.text for r in buckets.read(spark, path, buckets.owners(spark, path)).collect()}
    assert texts == {f"old {n}" for n in range(12)} - {"old 3"} | {"new 3", "new 99"}


def test_a_bucket_without_a_new_first_row_is_not_taken_in(spark, tmp_path):
    path = str(tmp_path / "table")
    one = spark.createDataFrame([("k1", 1, "b", "first")], SCHEMA)
    buckets.commit(spark, path, "run0", buckets.merge(path, "run0", one, "key", ORDER, 4, ["b"]))
    done = buckets.merge(path, "run1", spark.createDataFrame([("k1", 1, "c", "later")], SCHEMA), "key", ORDER, 4, ["b"])
    assert done.changed == [] and done.winners.isEmpty() and done.replaced.isEmpty() and set(done.owners.values()) == {"run0"}
