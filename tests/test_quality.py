import datetime as dt

import numpy as np
import pytest

from tertulia.operators import quality
from tertulia.plans import gold


@pytest.fixture(scope="module")
def posts(spark):
    rows = [("uno", "ana", "t", "u1", 1), ("", None, "t", "u1", 2), (None, "", "t", None, 10), ("cuatro", "b", "t", None, 4)]
    return spark.createDataFrame(rows, "title string, author string, text string, url string, score long")


ROW = {
    "source": "posts", "total_records": 4, "null_rate_title": 50.0, "null_rate_author": 50.0, "null_rate_text": 0.0,
    "null_rate_url": 50.0, "duplicate_rate": 50.0, "score_mean": 4.25, "score_median": 3.0, "score_min": 1,
    "score_max": 10, "title_len_mean": 3.0, "title_len_min": 0, "title_len_max": 6, "computed_at": "x"}


def test_governance_row(posts):
    assert quality.governance_row(posts, "posts", computed_at="x").first().asDict() == ROW


def test_single_figures_agree_with_the_row(posts):
    for figures in (quality.total_records(posts), quality.null_rates(posts), quality.duplicate_rate(posts),
                    quality.score_stats(posts), quality.length_stats(posts)):
        assert figures.first().asDict().items() <= ROW.items()


def test_sources_without_score_or_rows(spark, posts):
    table = gold.governance({
        "posts": {"df": posts}, "none": {"df": posts.limit(0)},
        "articles": {"df": posts, "columns": ("title", "author", "text", "url"), "score": None, "length_of": "text"},
    }, "x")
    got = {r.source: r for r in table.collect()}
    assert set(got) == {"posts", "articles"}
    assert (got["articles"].score_mean, got["articles"].score_median, got["articles"].score_max) == (0.0, 0.0, 0)
    assert (got["articles"].title_len_mean, got["articles"].title_len_min) == (1.0, 1)


def test_views(spark):
    table = spark.createDataFrame([tuple(ROW.values())], list(ROW))
    assert quality.avg_null_rate(table).first().avg_null_rate == pytest.approx(100 / 3)
    assert {(r.field, r.null_rate) for r in quality.null_rates_long(table).collect()} == {
        ("title", 50.0), ("author", 50.0), ("text", 0.0), ("url", 50.0)}
    assert quality.duplicate_by_source(table).first() == ("posts", 50.0)
    assert [(r.stat, r.value) for r in quality.length_long(table).collect()] == [("Min", 0.0), ("Mean", 3.0), ("Max", 6.0)]
    assert [(r.stat, r.value) for r in quality.score_long(table, "posts").collect()] == [
        ("Min", 1.0), ("Mean", 4.25), ("Median", 3.0), ("Max", 10.0)]
    assert quality.score_long(table, "articles").collect() == []
    assert quality.kpi_lookup(table, "posts", "total_records").first()[0] == 4


def test_no_rows(spark):
    empty = spark.createDataFrame([], "title string, author string, text string, url string, score long")
    assert quality.null_rates(empty).first().null_rate_title == 0.0
    assert quality.duplicate_rate(empty).first().duplicate_rate == 0.0
    assert quality.score_stats(empty).first() == (0.0, 0.0, 0, 0)
    assert quality.duplicate_report(empty).first() == (0, 0.0)
    assert quality.histogram(empty, "score").collect() == []
    assert quality.shape(empty).first() == (0, 5)


def test_profiles(posts):
    got = {r.column: (r.null_count, r.null_percent) for r in quality.null_profile(posts).collect()}
    # The empty string is a value here.
    assert got == {"title": (1, 25.0), "author": (1, 25.0), "text": (0, 0.0), "url": (2, 50.0), "score": (0, 0.0)}
    assert quality.duplicate_report(posts).first() == (2, 50.0)
    assert quality.shape(posts).first() == (4, 5)


def test_describe(spark):
    rng = np.random.default_rng(5)
    rows = [("a" * int(a), "b" * int(b)) for a, b in rng.integers(0, 60, (300, 2))]
    got = {r.column: r for r in quality.describe_lengths(spark.createDataFrame(rows, "x string, y string"), ["x", "y"]).collect()}
    for k, column in enumerate("xy"):
        n = [len(r[k]) for r in rows]
        r = got[column]
        np.testing.assert_allclose(
            [r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]],
            [300, np.mean(n), np.std(n, ddof=1), min(n), *np.quantile(n, [.25, .5, .75]), max(n)])


def test_iqr_report_is_two_sided(spark):
    df = spark.createDataFrame([(v,) for v in [-100, 1, 2, 3, 4, 5, 6, 7, 100]], "v long")
    r = quality.iqr_report(df, "v").first()
    assert (r.q1, r.q3, r.iqr, r.lower, r.upper, r.outliers, r.outlier_percent) == (2.0, 6.0, 4.0, -4.0, 12.0, 2, 22.22)


@pytest.mark.parametrize("values", [[5.0] * 4, [0.0, 1.0, 2.0, 30.0], list(np.random.default_rng(6).normal(size=500))])
def test_histogram_matches_numpy(spark, values):
    got = sorted(quality.histogram(spark.createDataFrame([(float(v),) for v in values], "v double"), "v").collect())
    counts, edges = np.histogram(values, bins=30)
    assert [r.n for r in got] == list(counts)
    np.testing.assert_allclose([r.lower for r in got] + [got[-1].upper], edges, atol=1e-12)


def test_date_range(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 2),), (None,), (dt.date(2026, 1, 1),)], "d date")
    assert quality.date_range(df, "d").first() == (dt.date(2026, 1, 1), dt.date(2026, 1, 2))
