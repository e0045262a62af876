import numpy as np
import pytest
from pyspark.sql import functions as F

from tertulia.operators.quantiles import _CODED, approx_quantiles, exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("name, values", [
    ("one", [7.0]),
    ("two", [1.0, 2.0]),
    ("equal", [3.5] * 50),
    ("signs", list(range(-40, 41))),
    ("hot", [5.0] * 700 + list(range(300))),
    ("narrow", list(1.7e9 + np.random.default_rng(1).random(500))),
    ("wide", list(np.random.default_rng(2).lognormal(0, 9, 800))),
    ("small", list(np.random.default_rng(3).normal(0, 1e-9, 500))),
])
def test_matches_numpy(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    got = exact_quantiles(df, "v", PROBS).first().quantiles
    np.testing.assert_allclose(got, np.quantile(values, PROBS), rtol=1e-12)
    hazen = exact_quantiles(df, "v", PROBS, rule="hazen").first().quantiles
    np.testing.assert_allclose(hazen, np.quantile(values, PROBS, method="hazen"), rtol=1e-12)


def test_groups_with_null_keys(spark):
    rng = np.random.default_rng(4)
    rows = [(k, int(rng.integers(0, 2)), int(rng.integers(-500, 500))) for k in ("a", "b", None) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, g int, v int")
    got = {(r.k, r.g): r.quantiles for r in exact_quantiles(df, "v", [0.25, 0.5], by=["k", "g"]).collect()}
    assert len(got) == 6
    for key, quantiles in got.items():
        values = [v for k, g, v in rows if (k, g) == key]
        np.testing.assert_allclose(quantiles, np.quantile(values, [0.25, 0.5]))


def test_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantiles(df, "v", [0.5]).collect() == []


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.createDataFrame([(1.0,)], "v double"), "v", [0.5], rule="other")


def test_approximate_is_near(spark):
    df = spark.range(10001).withColumnRenamed("id", "v")
    assert abs(approx_quantiles(df, "v", [0.5]).first().quantiles[0] - 5000) <= 2


def test_codes_are_the_bits_of_a_double(spark):
    values = sorted({s * m * 2.0 ** e for s in (-1, 1) for e in (-1074, -1030, -1022, -40, -14, -1, 0, 1, 3, 52, 1000, 1022, 1023) for m in (1, 1.25, 1.9999999)}
                    | {k * 1e-6 for k in range(100)} | {0.0, float("inf"), float("-inf"), 7.999999999999999, 8.0, 0.1, 1e308, 5e-324}
                    | set(np.random.default_rng(7).integers(0, 0x7FE0 << 48, 3000).view(np.float64).tolist()))
    values += [-v for v in values]
    coded = spark.sql(f"WITH {', '.join(_CODED)} SELECT _v, _code FROM coded", values=spark.createDataFrame([(v,) for v in values], "_v double"))
    got = {r._v: r._code for r in coded.collect()}
    for v, code in got.items():
        bits = int(np.array(abs(v)).view(np.int64))
        assert code == (-bits if v < 0 else bits)


def test_bins_are_split_until_their_values_are_told_apart(spark):
    """Thousands of values that share all but their last bits, between others."""
    base = np.float64(1234.5).view(np.int64)
    close = (base + np.arange(5000)).view(np.float64)
    values = [1.0] * 2000 + close.tolist() + [1e9] * 2000
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    got = exact_quantiles(df, "v", PROBS).first().quantiles
    assert got == pytest.approx(np.quantile(values, PROBS).tolist(), rel=0, abs=1e-12)
    by = exact_quantiles(df.withColumn("g", F.when(F.col("v") < 2, None).otherwise(F.col("v") > 2000)), "v", [0.5], ["g"])
    assert {r.g: r.quantiles[0] for r in by.collect()} == {None: 1.0, False: np.quantile(close, 0.5), True: 1e9}


def test_no_exchange_holds_values(spark):
    """A column of different values: what is shuffled are counts of bins, not the column."""
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 0.001 + 100).alias("v"))
        out = exact_quantiles(df, "v", [0.25, 0.75])
        assert out.first().quantiles == pytest.approx(np.quantile(np.arange(200_000) * 0.001 + 100, [0.25, 0.75]))
        plan = out._jdf.queryExecution().executedPlan()
        sent = []

        def walk(node):
            if node.nodeName() == "Exchange":
                sent.append(node.metrics().apply("shuffleRecordsWritten").value())
            if node.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage", "TableCacheQueryStage")):
                walk(node.plan())
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                walk(node.executedPlan())
            for k in range(node.children().size()):
                walk(node.children().apply(k))

        walk(plan)
        # Three doublings hold some 1,024 bins each; a bin that is split holds some hundred values.
        assert sent and max(sent) < 4 * 4096
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_and_mixed_magnitudes(spark):
    values = [k * 1e-7 for k in range(1000)] + [-(10.0 ** k) for k in range(-10, 10)] + [5.0] * 500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    expected = df.agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("p")).first().p
    assert exact_quantiles(df, "v", [0.1, 0.5, 0.9]).first().quantiles == pytest.approx(expected)
