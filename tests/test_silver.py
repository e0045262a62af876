import datetime as dt

from pyspark.sql import Observation

from tertulia.operators import silver
from tertulia.operators.dedup import keep_first
from tertulia.plans.silver import post_stage_counts, process_articles, process_posts, valid_posts, valid_scores

POST = "source_file string, pos long, url string, title string, text string, author string, date string, score string"
LONG = "un texto largo"


def posts(spark, *rows):
    return spark.createDataFrame(list(rows), POST)


def test_first_by_file_then_position(spark):
    df = posts(
        spark,
        ("b.json", 0, "u1", "t", LONG, None, None, "1"), ("a.json", 5, "u1", "t", LONG, None, None, "2"),
        ("a.json", 9, "u1", "t", LONG, None, None, "3"), ("a.json", 1, "u1", "other", LONG, None, None, "4"),
        ("a.json", 2, None, "t", LONG, None, None, "5"), ("a.json", 3, None, "t", LONG, None, None, "6"))
    order = ["source_file", "pos"]
    assert sorted(r.score for r in keep_first(df, ["url", "title"], order).collect()) == ["2", "4", "5"]
    assert sorted(r.score for r in keep_first(df, ["url"], order).collect()) == ["4", "5"]
    assert keep_first(df, ["url"], order).columns == df.columns
    assert keep_first(df.select("url"), ["url"], ["url"]).count() == 2


def test_dirty_posts(spark):
    df = posts(
        spark,
        ("a", 0, "https://1", " x1234 ", "d" * 11, None, "1775572994.5", "abc"),
        ("a", 1, "https://2", None, "d" * 11, "", "", "1"),
        ("a", 2, "https://3", "abc", "d" * 11, "", "", "1"),
        ("a", 3, "https://4", "abcd", "d" * 10, "", "", "1"),
        ("a", 4, None, "abcd", "d" * 11, "", "", "1"),
        ("a", 5, "12345", "abcd", "d" * 11, "", "", "1"),
        ("a", 6, "https://7", "abcd", "d" * 11, "", "", None),
        ("a", 7, "https://8", " abc ", "d" * 11, "", "", "1"),
        ("a", 8, "https://9", "abcd", None, "", "", "1"))
    got = {r.url: r for r in valid_posts(df).collect()}
    assert set(got) == {"https://1", "https://7"}
    first = got["https://1"]
    assert (first.title, first.author, first.score) == ("x1234", "unknown", 0)
    assert first.date == dt.datetime(2026, 4, 7, 14, 43, 14, 500000)
    assert (got["https://7"].author, got["https://7"].date, got["https://7"].score) == ("", None, 0)


def test_upper_fence_only(spark):
    df = spark.createDataFrame([(v,) for v in [-1000, 1, 2, 3, 4, 5, 6, 7, 8, 12, 13, 100]], "score long")
    # Q1 = 1.75 → over twelve values: Q1 = 2.75, Q3 = 9, fence = 9 + 1.5 · 6.25 = 18.375.
    assert silver.upper_fence(df).first().fence == 18.375
    assert sorted(r.score for r in silver.iqr_upper_fence(df).collect())[-1] == 13
    assert silver.iqr_upper_fence(df).count() == 11


def test_process_posts(spark):
    df = posts(spark, *[("a", n, f"https://{n}", "El título", "hola mundo http://x.y", "ana", "0", str(n)) for n in range(9)],
               ("a", 99, "https://99", "El título", LONG, "ana", "0", "9999"))
    out = process_posts(df)
    assert tuple(out.columns) == silver.POST_COLUMNS
    assert out.count() == 9
    assert {(r.title_clean, r.text_clean) for r in out.collect()} == {("título", "hola mundo")}
    assert process_posts(posts(spark)).collect() == []


def exchanges(df):
    """What each shuffle of the plan holds."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange":
            found.append(node.schema().simpleString())
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        for k in range(node.subqueries().size()):
            walk(node.subqueries().apply(k))
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            walk(node.initialPlan())

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_the_fence_moves_no_text(spark, tmp_path):
    path = str(tmp_path / "posts")
    posts(spark, ("a", 0, "https://1", "abcd", LONG, "x", "0", "1")).write.parquet(path)
    raw = spark.read.parquet(path)
    moved = exchanges(silver.upper_fence(valid_scores(raw)))
    assert moved and not any("text" in schema for schema in moved)
    # Whole rows are shuffled once, for the rows that stay.
    assert sum("text" in schema for schema in exchanges(process_posts(raw))) == 1
    plan = process_posts(raw)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_narrow_scores_are_those_of_valid_posts(spark):
    rows = [(f, n, f"https://{n % 5}" if n % 7 else None, " abcd "[: n % 9], (LONG * 2)[: n % 23] or None, "x", "0", str(n % 4) if n % 3 else "n/a")
            for f in "ab" for n in range(60)]
    raw = posts(spark, *rows)
    for minimums in (silver.POST_MIN_CHARS, {"title": 2}, {"text": 5}):
        whole = sorted(r.score for r in valid_posts(raw, min_chars=minimums).collect())
        assert sorted(r.score for r in valid_scores(raw, min_chars=minimums).collect()) == whole and whole


def test_process_articles(spark):
    schema = ("source_file string, pos long, titulo string, autor string, fecha string, url string, extracto string, "
              "etiquetas string, contenido string, fuente string")
    body = "c" * 51
    rows = [("a", 0, " Nota ", None, "2026-04-26T21:47:13-05:00", "https://1", None, None, body, "f"),
            ("a", 1, "Repetida", "x", None, "https://1", None, None, body, "f"),
            ("a", 2, "Corta", "x", None, "https://2", None, None, "c" * 50, "f"),
            ("a", 3, "Mala fecha", "", "ayer", "https://3", "e", "t", body, None)]
    out = process_articles(spark.createDataFrame(rows, schema))
    assert tuple(out.columns) == silver.ARTICLE_COLUMNS
    got = {r.url: r for r in out.collect()}
    assert set(got) == {"https://1", "https://3"}
    assert (got["https://1"].titulo, got["https://1"].autor, got["https://1"].etiquetas) == ("Nota", "Desconocido", "")
    assert got["https://1"].fecha == dt.datetime(2026, 4, 27, 2, 47, 13)
    assert (got["https://3"].fecha, got["https://3"].autor, got["https://3"].fuente) == (None, "", None)


def test_counts(spark):
    df = spark.range(10)
    assert {r.stage: r.rows for r in silver.stage_counts({"all": df, "few": df.where("id < 3")}).collect()} == {"all": 10, "few": 3}
    rows = [("a", n, f"https://{n % 8}", "abcd", LONG if n % 8 else "corto", "x", "0", str(n)) for n in range(16)]
    raw = posts(spark, *rows, ("a", 99, "https://99", "abcd", LONG, "x", "0", "999"))
    got = {r.stage: r.rows for r in post_stage_counts(raw).collect()}
    assert got == {"raw": 17, "deduplicated": 9, "valid": 8, "kept": 7}
    assert {r.rows for r in post_stage_counts(posts(spark)).collect()} == {0}
    seen = Observation("rows")
    silver.observe_rows(df, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10}
