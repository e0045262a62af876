import datetime as dt

import pytest

from tertulia.operators import analytics, corpus, marts
from tertulia.plans import gold

D = [dt.date(2026, 1, n) for n in range(1, 12)]


@pytest.fixture(scope="module")
def silver(spark):
    posts = spark.createDataFrame([
        ("Uno", "uno", "x", "mejor paz gobierno", "ana", dt.datetime(2026, 1, 1, 23, 59), 4, "https://1"),
        ("Dos", "", "x", "guerra gobierno gobierno", "ana", dt.datetime(2026, 1, 2), 6, "https://2"),
        ("Tres", "tres", "x", "mesa", "luz", dt.datetime(2026, 1, 2), 1, "https://3"),
        ("Otra", "tres", "x", "mesa", "luz", None, 9, "https://3"),
    ], "title string, title_clean string, text string, text_clean string, author string, date timestamp, score long, url string")
    articles = spark.createDataFrame([
        ("Nota", "gobierno crisis", "ana", dt.datetime(2026, 1, 2), "https://a"),
        ("Repetida", "copia", "ana", dt.datetime(2026, 1, 2), "https://1"),
    ], "titulo string, contenido_clean string, autor string, fecha timestamp, url string")
    return posts, articles


@pytest.fixture(scope="module")
def scored(silver):
    return gold.scored_corpus(*silver, posts_source="forum", articles_source="news",
                              order=("source", "day")).persist()


def test_corpus(scored):
    got = {r.url: (r.title, r.text, r.source, str(r.day), r.score, r.sentiment, round(r.polarity, 4)) for r in scored.collect()}
    assert got == {
        "https://1": ("Uno", "uno mejor paz gobierno", "forum", "2026-01-01", 4, "positive", 1.0),
        "https://2": ("Dos", " guerra gobierno gobierno", "forum", "2026-01-02", 6, "negative", -1.0),
        "https://3": ("Otra", "tres mesa", "forum", "None", 9, "neutral", 0.0),
        "https://a": ("Nota", "gobierno crisis", "news", "2026-01-02", 0, "negative", -1.0),
    }


def test_only_one_source(silver):
    assert gold.scored_corpus(silver[0], None).count() == 3
    assert gold.scored_corpus(None, silver[1]).count() == 2
    with pytest.raises(ValueError):
        gold.scored_corpus(None, None)


def test_marts(scored):
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    assert rows(marts.volume_trend(scored)) == sorted(map(str, [
        ("forum", D[0], 1), ("forum", D[1], 1), ("forum", None, 1), ("news", D[1], 1)]))
    assert [tuple(r) for r in marts.top_keywords(scored).collect()] == [
        ("gobierno", "forum", 3), ("crisis", "news", 1), ("gobierno", "news", 1), ("guerra", "forum", 1),
        ("mejor", "forum", 1), ("mesa", "forum", 1), ("tres", "forum", 1)]
    assert [tuple(r) for r in marts.top_keywords(scored, 2).collect()] == [("gobierno", "forum", 3), ("crisis", "news", 1)]
    assert rows(marts.score_trend(scored, "forum")) == sorted(map(str, [(D[0], 4.0, 1), (D[1], 6.0, 1), (None, 9.0, 1)]))
    assert [tuple(r) for r in marts.top_authors(scored).collect()] == [("ana", "forum", 2), ("ana", "news", 1), ("luz", "forum", 1)]
    assert rows(marts.sentiment_dist(scored)) == sorted(map(str, [
        ("forum", "positive", 1), ("forum", "negative", 1), ("forum", "neutral", 1), ("news", "negative", 1)]))
    assert rows(marts.keywords_sentiment(scored).where("word = 'gobierno'")) == sorted(map(str, [
        ("gobierno", "negative", "forum", 2), ("gobierno", "positive", "forum", 1), ("gobierno", "negative", "news", 1)]))


def test_facts_give_the_same_marts(scored):
    daily, words = marts.daily_facts(scored), marts.word_facts(scored)
    for mart, facts in (
        (marts.volume_trend, daily), (marts.sentiment_dist, daily), (marts.sentiment_trend, daily),
        (lambda df: marts.score_trend(df, "forum"), daily), (marts.top_keywords, words), (marts.keywords_sentiment, words),
    ):
        assert sorted(map(str, mart(facts).collect())) == sorted(map(str, mart(scored).collect()))


def test_top_k_needs_no_full_sort(scored):
    plan = marts.top_keywords(scored)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_write_marts(spark, scored, tmp_path):
    from tertulia.sources.snapshots import read_latest_run

    out = str(tmp_path / "gold")
    gold.write_marts(spark, scored, out, "20260101_000000", "forum")
    paths = gold.write_marts(spark, scored, out, "20260108_000000", "forum")
    assert set(paths) == {"volume", "keywords", "score_trend", "authors", "sentiment_dist", "sentiment_trend", "keywords_sentiment"}
    volume = read_latest_run(spark, paths["volume"])
    assert {"source", "fecha", "record_count", "run_ts"} <= set(volume.columns) and volume.count() == 4
    assert {r.run_ts for r in volume.collect()} == {"20260108_000000"}
    assert "autor" in read_latest_run(spark, paths["authors"]).columns
    assert read_latest_run(spark, paths["keywords"]).count() == 7


def test_published_names(spark):
    assert marts.published(spark.createDataFrame([(1, 2)], "day int, n int")).columns == ["fecha", "n"]


TREND = "source string, day date, avg_polarity double, record_count long"


def test_moving_average_counts_rows_not_days(spark):
    days = [D[n] for n in (0, 1, 2, 3, 4, 5, 9, 10)] + [None]
    df = spark.createDataFrame([("s", d, float(n), 1) for n, d in enumerate(days)] + [("t", D[0], 5.0, 1)], TREND)
    got = {(r.source, r.day): r for r in analytics.polarity_ma7(df).collect()}
    assert got["s", D[0]].polarity_ma_7d == 0.0 and got["s", D[9]].polarity_ma_7d == 3.0
    assert got["s", D[10]].polarity_ma_7d == 4.0 and got["s", None].polarity_ma_7d == 5.0
    assert got["t", D[0]].polarity_ma_7d == 5.0
    by_day = {(r.source, r.day): r.polarity_ma_days for r in analytics.polarity_ma_days(df).collect()}
    assert by_day["s", D[9]] == (3 + 4 + 5 + 6) / 4 and ("s", None) not in by_day


def test_monthly_means_of_daily_means(spark):
    df = spark.createDataFrame(
        [("s", D[0], 1.0, 100), ("s", D[1], 0.0, 1), ("s", dt.date(2026, 2, 3), 0.5, 1), ("s", None, 9.0, 1)], TREND)
    assert sorted(tuple(r) for r in analytics.monthly_polarity(df).collect()) == [
        ("s", D[0], 0.5), ("s", dt.date(2026, 2, 1), 0.5)]


def test_null_days_match_in_the_join(spark):
    trend = spark.createDataFrame([("f", D[0], 1.0, 1), ("f", None, 0.5, 1), ("n", D[0], 9.0, 1)], TREND)
    scores = spark.createDataFrame([(D[0], 3.0, 2), (None, 4.0, 1), (D[1], 5.0, 1)], "day date, avg_score double, post_count long")
    got = sorted((str(r.day), r.avg_polarity, r.avg_score) for r in analytics.polarity_vs_score(trend, scores, "f").collect())
    assert got == [("2026-01-01", 1.0, 3.0), ("None", 0.5, 4.0)]


def test_box(spark):
    values = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 5.0]
    df = spark.createDataFrame([("s", D[n], v, 1) for n, v in enumerate(values)], TREND)
    summary, outliers = analytics.polarity_box(df)
    r = summary.first()
    # Ranks 0.25·8 - 0.5 = 1.5, 3.5 and 5.5.
    assert [round(x, 9) for x in (r.q1, r.median, r.q3, r.lower_whisker, r.upper_whisker)] == [0.15, 0.35, 0.55, 0.0, 0.6]
    assert r.outliers == 1 and [x.avg_polarity for x in outliers.collect()] == [5.0]


def test_shares(spark):
    dist = spark.createDataFrame(
        [("a", " Positive", 1), ("a", "negative", 1), ("a", "odd", 1), ("b", "neutral", 2)], "source string, sentiment string, count long")
    assert sorted((r.source, r.sentiment, r.percentage) for r in analytics.share_by_source(dist).collect()) == [
        ("a", "negative", 33.33), ("a", "positive", 33.33), ("b", "neutral", 100.0)]
    assert sorted((r.sentiment, r["count"], r.total, r.share) for r in analytics.overall_sentiment(dist).collect()) == [
        ("negative", 1, 4, 25.0), ("neutral", 2, 4, 50.0), ("positive", 1, 4, 25.0)]
    ordered = analytics.normalize_label(dist).orderBy(analytics.label_order(), "source")
    assert [r.sentiment for r in ordered.collect()] == ["positive", "neutral", "negative"]


def test_ten_words_per_label_after_the_cut(spark):
    rows = [(f"w{n:02}", "positive", "a", 100 - n) for n in range(12)] + [("w11", "positive", "b", 500), ("x", "odd", "a", 9)]
    df = spark.createDataFrame(rows, "word string, sentiment string, source string, frequency long")
    got = sorted((r.word, r.frequency) for r in analytics.top10_per_sentiment(df).collect())
    assert len(got) == 10 and got[-1] == ("w11", 589) and ("w09", 91) not in got


def test_notebook_figures(spark):
    df = spark.createDataFrame(
        [("a", 3, "x", "u1"), ("b", 9, None, "u1"), ("c", None, "x", "u2"), ("d", 5, "y", None)],
        "title string, score long, author string, url string")
    assert analytics.basic_stats(df).first() == (4, 5.67, 9)
    assert [r.title for r in analytics.top5_by_score(df, 2).collect()] == ["b", "d"]
    assert analytics.distinct_authors(df).first()[0] == 2 == analytics.distinct_authors(df, approximate=True).first()[0]
    assert [tuple(r) for r in analytics.author_counts(df).collect()] == [("x", 2), ("y", 1)]
    assert sorted(r.title for r in analytics.combine_snapshots(df, ["title"]).collect()) == ["a", "c", "d"]
    assert analytics.preview(df, 2).count() == 2
    assert corpus.COLUMNS[0] == "url"
