import pytest

from tertulia.functions.sentiment import with_sentiment


def score(spark, text, **options):
    row = with_sentiment(spark.createDataFrame([(text,)], "text string"), **options).first()
    return row.sentiment, round(row.polarity, 4)


@pytest.mark.parametrize("text, expected", [
    (None, ("neutral", 0.0)),
    ("   ", ("neutral", 0.0)),
    ("casa mesa", ("neutral", 0.0)),
    ("bueno bueno malo", ("positive", 0.3333)),
    ("Malo\tMALO bueno", ("negative", -0.3333)),
    # 11 against 9 is exactly 0.1, which is neutral.
    ("bueno " * 11 + "malo " * 9, ("neutral", 0.1)),
    ("bueno " * 9 + "malo " * 11, ("neutral", -0.1)),
    ("bueno " * 111 + "malo " * 89, ("positive", 0.11)),
    ("bueno, malo.", ("neutral", 0.0)),
])
def test_default_lexicons(spark, text, expected):
    assert score(spark, text) == expected


def test_label_uses_the_unrounded_ratio(spark):
    # (20001 - 16364) / 36365 = 0.10001…: positive, although it rounds to 0.1.
    assert score(spark, "bueno " * 20001 + "malo " * 16364) == ("positive", 0.1)


def test_tie_rounds_to_even(spark):
    assert score(spark, "p " * 33 + "n " * 31, positive=["p"], negative=["n"])[1] == 0.0312


def test_lexicons_are_parameters(spark):
    assert score(spark, "x y y", positive=["x"], negative=["y"]) == ("negative", -0.3333)
    assert score(spark, "x y", positive=["x", "y"], negative=["y"]) == ("positive", 0.3333)
    assert score(spark, "x", positive=[], negative=[]) == ("neutral", 0.0)


def test_a_filter_on_labels_does_not_score_texts_again(spark):
    from tertulia.operators import analytics, marts

    df = spark.createDataFrame([("a", "bueno x"), ("a", "malo"), ("b", "x"), ("b", None)], "source string, text string")
    dist = marts.sentiment_dist(with_sentiment(df, "text"))
    for out in (analytics.normalize_label(dist), analytics.overall_sentiment(dist)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert sorted(map(tuple, analytics.normalize_label(dist).collect())) == [("a", "negative", 1), ("a", "positive", 1), ("b", "neutral", 2)]
