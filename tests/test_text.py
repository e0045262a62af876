import random
import re

import pytest
from pyspark.sql import functions as F

from tertulia.functions import text as t
from tertulia.functions.dates import epoch_to_ts, iso_to_utc, month_start, to_number, to_score
from tertulia.functions.wordlists import KEYWORDS, KEYWORDS_ACCENTED, NEGATIVE, POSITIVE, STOPWORDS


def one(spark, value, expression, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expression(F.col("v")).alias("r")).first().r


def test_word_lists():
    assert (len(STOPWORDS), len(POSITIVE), len(NEGATIVE)) == (53, 70, 114)
    assert not POSITIVE & NEGATIVE
    assert "política" in KEYWORDS_ACCENTED and "política" not in KEYWORDS


@pytest.mark.parametrize("value, expected", [
    ("Corrupción: ¡más! https://x.co/a\u00a0fin", "corrupción fin"),
    ("www.uno.co dos, TRES", "dos tres"),
    ("de la el y", ""),
    ("", ""),
    (None, ""),
    ("ab abc", "abc"),
    ("½½½ ok", "½½½"),
    ("tres\u200bdos", "tres dos"),
    ("señor&amp;#x200B;", "señor amp x200b"),
    ("a_b c-d-efg", "a_b efg"),
    ("cafe\u0301teria", "cafe teria"),
])
def test_clean_text(spark, value, expected):
    assert one(spark, value, t.clean_text) == expected


def by_hand(text):
    text = re.sub(r"http\S+|www\S+", "", text.lower())
    return " ".join(w for w in re.sub(r"[^\w\s]", " ", text).split() if w not in STOPWORDS and len(w) > 2)


def test_clean_text_against_plain_python(spark):
    rng = random.Random(7)
    alphabet = "aáb ñZ_9.,-\n\t\xa0 \x1c　½http://www.²٣あ"
    texts = ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(400)]
    got = spark.createDataFrame([(x,) for x in texts], "v string").select("v", t.clean_text("v").alias("r")).collect()
    assert {r.v: r.r for r in got} == {x: by_hand(x) for x in texts}


def test_strip_removes_what_python_strips(spark):
    every = [chr(c) for c in range(0x3100) if c != 0]
    df = spark.createDataFrame([(c, c + "x" + c) for c in every], "c string, v string")
    got = {r.c: r.r for r in df.select("c", t.strip("v").alias("r")).collect()}
    assert got == {c: (c + "x" + c).strip() for c in every}


def test_keyword_is_a_substring(spark):
    assert one(spark, "la leyenda", t.has_keyword)
    assert not one(spark, "política", t.has_keyword)
    assert one(spark, "política", lambda c: t.has_keyword(c, KEYWORDS_ACCENTED))
    assert not one(spark, "ley", lambda c: t.has_keyword(c, []))
    assert one(spark, "a.b", lambda c: t.has_keyword(c, ["a.b"]))
    assert not one(spark, "axb", lambda c: t.has_keyword(c, ["a.b"]))


def test_tags_and_urls(spark):
    assert one(spark, "post tag-paz-total  tag-tag-x cat-tag-y", t.class_tags) == "paz total, x"
    assert one(spark, None, t.class_tags) == ""
    assert one(spark, "/a", lambda c: t.absolute_url(c, "https://h")) == "https://h/a"
    assert one(spark, "http://a", lambda c: t.absolute_url(c, "https://h")) == "http://a"
    assert one(spark, [" b", "a", "", "b ", None], t.distinct_tags, "v array<string>") == "b, a"
    assert one(spark, "", lambda c: t.first_non_empty(c, F.lit("z"))) == "z"


def test_lenient_numbers_and_dates(spark):
    assert one(spark, "abc", to_number) is None
    assert [one(spark, v, to_score) for v in ("12.7", "-12.7", "abc", None, "NaN", "1e3")] == [12, -12, 0, 0, 0, 1000]
    assert str(one(spark, "1775572994.5", epoch_to_ts)) == "2026-04-07 14:43:14.500000"
    assert one(spark, "", epoch_to_ts) is None and one(spark, "1e30", epoch_to_ts) is None
    assert str(one(spark, "2026-04-26T21:47:13-05:00", iso_to_utc)) == "2026-04-27 02:47:13"
    assert str(one(spark, "2026-04-26T21:47:13", iso_to_utc)) == "2026-04-26 21:47:13"
    assert one(spark, "ayer", iso_to_utc) is None and one(spark, "12:30", iso_to_utc) is None
    assert str(one(spark, "2026-04-26", lambda c: month_start(c.cast("date")))) == "2026-04-01"
