"""Runs in buckets: the same results, and no exchange for them."""

import pytest
from pyspark.sql import functions as F

from tertulia.operators.corpus import dedup_url
from tertulia.operators.dedup import keep_first
from tertulia.sources import bucketed


@pytest.fixture
def table(spark, tmp_path):
    names = []

    def make(name, runs):
        for run, rows in runs.items():
            bucketed.append_run(rows, name, str(tmp_path / name), run, buckets=6)
        names.append(name)
        return spark.table(name)

    yield make
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def silver(spark, low, high, shift):
    return spark.range(low, high).select(
        F.when(F.col("id") % 9 == 0, None).otherwise(F.concat(F.lit("u"), (F.col("id") % 40).cast("string"))).alias("url"),
        (F.col("id") + shift).alias("score"), F.repeat(F.col("id").cast("string"), 20).alias("text"))


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_over_runs_shuffles_nothing(spark, table, tmp_path):
    runs = {"20240101_000000": silver(spark, 0, 100, 0), "20240102_000000": silver(spark, 50, 160, 7), "20240103_000000": silver(spark, 0, 0, 0)}
    rows = table("bucketed_posts", runs)
    first = dedup_url(rows, ["run_ts", "score"])
    assert "Exchange" not in plan(first)
    plain = None
    for run, df in runs.items():
        df = df.withColumn("run_ts", F.lit(run))
        plain = df if plain is None else plain.unionByName(df)
    assert sorted(map(str, first.collect())) == sorted(map(str, keep_first(plain, ["url"], ["run_ts", "score"]).select(*first.columns).collect()))
    later = bucketed.read_runs(spark, "bucketed_posts", "20240102_000000")
    assert later.count() == 110 and all("20240101" not in f for f in later.inputFiles())
    with pytest.raises(ValueError, match="already"):
        bucketed.append_run(runs["20240101_000000"], "bucketed_posts", str(tmp_path / "bucketed_posts"), "20240101_000000", buckets=6)


def test_joins_of_two_tables_shuffle_nothing(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        one, two = table("bucketed_one", {"20240101_000000": silver(spark, 0, 100, 0)}), table("bucketed_two", {"20240101_000000": silver(spark, 30, 80, 0)})
        joined = one.select("url", "score").join(two.select("url", F.col("score").alias("other")), "url")
        assert "Exchange" not in plan(joined)
        want = silver(spark, 0, 100, 0).select("url", "score").join(silver(spark, 30, 80, 0).select("url", F.col("score").alias("other")), "url")
        assert sorted(joined.collect()) == sorted(want.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_table_is_known_again(spark, table, tmp_path):
    rows = table("bucketed_again", {"20240101_000000": silver(spark, 0, 100, 0), "20240102_000000": silver(spark, 0, 10, 0)})
    before = sorted(map(str, rows.collect()))
    spark.sql("DROP TABLE bucketed_again")  # external: the files stay
    bucketed.register(spark, "bucketed_again", str(tmp_path / "bucketed_again"), "url STRING, score BIGINT, text STRING", buckets=6)
    again = spark.table("bucketed_again")
    assert sorted(map(str, again.collect())) == before and "Exchange" not in plan(dedup_url(again, ["run_ts", "score"]))
