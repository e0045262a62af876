"""A key that holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tertulia.operators.bronze import first_n_per_batch
from tertulia.operators.dedup import keep_first, keep_first_late
from tertulia.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000)
    return spark.range(0, 300000, 1, 8).select(key.alias("k"), (F.col("id") * 7919 % 300007).alias("o"))


def test_first_row(hot):
    first = keep_first(hot.withColumn("payload", F.col("o") * 2), ["k"], ["o"])
    lowest = hot.groupBy("k").agg(F.min("o").alias("o")).withColumn("payload", F.col("o") * 2)
    assert first.exceptAll(lowest).isEmpty() and lowest.exceptAll(first).isEmpty()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_quantiles(hot):
    probs = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])
    assert exact_quantiles(hot, "k", [0.25, 0.5, 0.75]).first().quantiles == hot.agg(F.percentile("k", probs)).first()[0]


def test_rows_per_batch(hot):
    kept = first_n_per_batch(hot, ["k"], ["o"], 20)
    assert kept.groupBy("k").count().where("count > 20").isEmpty()
    assert kept.where("k = -1").agg(F.sum("o")).first()[0] == sum(
        r.o for r in hot.where("k = -1").orderBy("o").limit(20).collect())


def test_late_rows_are_the_first_ones_and_no_body_is_in_the_first_shuffle(spark, hot, tmp_path):
    hot.select(F.when(F.col("k") == 7, None).otherwise(F.col("k")).alias("k"), "o", F.repeat(F.lit("body "), 3).alias("body"),
               (F.col("o") % 5).alias("_late_row")).repartition(5).write.parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows"))
    late = keep_first_late(table, ["k"], ["o"])
    first = keep_first(table, ["k"], ["o"]).select(*table.columns)
    assert late.columns == table.columns and late.count() == first.count()
    assert late.exceptAll(first).isEmpty() and first.exceptAll(late).isEmpty()
    found = []

    def walk(node):
        if node.nodeName() == "Exchange" and "partial_min_by" in node.toString():
            found.append(node.schema().simpleString())
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            walk(node.initialPlan())

    walk(late._jdf.queryExecution().executedPlan())
    assert found and not any("body" in schema for schema in found)
    # Copies that are equal in every column are still one row.
    twice = table.where("k = 3").union(table.where("k = 3"))
    twice.write.parquet(str(tmp_path / "twice"))
    assert keep_first_late(spark.read.parquet(str(tmp_path / "twice")), ["k"], ["o"]).count() == 1
