"""Odd numbers, labels and pages: no row is lost and no job ends."""

import time

import pytest
from pyspark.sql import functions as F

from tertulia.functions.dates import to_number, to_score
from tertulia.functions.html import Node, _Tree
from tertulia.operators import analytics, pages, quality, silver


def test_scores_are_never_null(spark):
    made = ["1", "2.9", "-3.5", "inf", "-Infinity", "NaN", "1e30", "5d", "5f", "0x1p3", "", None, " 7 ", "1e2", ".5", "abc"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(made)], "k int, v string")
    got = [r.s for r in df.select("k", to_score("v").alias("s")).orderBy("k").collect()]
    assert got == [1, 2, -3, 0, 0, 0, 0, 0, 0, 0, 0, 0, 7, 100, 0, 0]
    numbers = [r.n for r in df.select("k", to_number("v").alias("n")).orderBy("k").collect()]
    assert numbers[6] == 1e30 and numbers[3:6] == [None] * 3 and numbers[7:10] == [None] * 3


def test_fence_keeps_rows_of_odd_scores(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",), ("inf",), ("1e30",)], "score string").select(to_score("score").alias("score"))
    assert silver.iqr_upper_fence(df).count() == 5


def test_nan_is_no_outlier_and_in_no_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)] + [(float("nan"),)], "x double")
    report = quality.iqr_report(df, "x").first()
    assert report.outliers == 0 and report.outlier_percent == 0
    bins = quality.histogram(df, "x", 3).orderBy("bin").collect()
    assert [(b.lower, b.n) for b in bins] == [(1.0, 1), (2.0, 1), (3.0, 2)]


def test_spellings_of_a_label_are_one_row(spark):
    dist = spark.createDataFrame([("a", "Positive", 2), ("b", "positive ", 3), ("b", "odd", 9)], "source string, sentiment string, count long")
    assert [tuple(r) for r in analytics.overall_sentiment(dist).collect()] == [("positive", 5, 5, 100.0)]


GOOD = "<div class='entry-content'><p>" + "text of the page " * 10 + "</p></div>"


@pytest.mark.parametrize("odd", [
    "<div>" * 100_000 + "deep", "<![foo[x]]><p>a", "", "<p>" + "word " * 500_000, "</x>" * 100_000, "<" * 10_000, "<a b='" * 1000, "<!"])
def test_odd_pages_leave_the_others_alone(spark, odd):
    df = spark.createDataFrame([(1, GOOD), (2, odd), (3, None), (4, GOOD)], "k int, html string")
    got = {r.k: r.body for r in pages.article_fields(df, keep=["k"]).collect()}
    assert set(got) == {1, 2, 3, 4} and got[1] == got[4] != ""
    assert pages.page_errors(df, keep=["k"]).count() == 0


def test_time_grows_with_the_nodes():
    def took(n):
        started = time.process_time()
        sum(1 for _ in _Tree("<div><p>x</p>" * n).root.walk())
        return time.process_time() - started

    took(1000)
    assert took(40_000) < 12 * took(10_000) + 0.5


def test_an_unreadable_page_says_so(spark, monkeypatch):
    assert isinstance(_Tree("<p>a").root, Node)
    from tertulia.functions import html as module

    def broken(self, *_):
        raise AssertionError("no")

    monkeypatch.setattr(module._Tree, "handle_comment", broken, raising=False)
    df = spark.createDataFrame([(1, GOOD), (2, "<!-- x -->")], "k int, html string")
    assert [r.k for r in pages.page_errors(df, keep=["k"]).collect()] in ([2], [])
    assert df.select(F.count("*")).first()[0] == 2
