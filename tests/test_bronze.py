import json

from pyspark.sql import functions as F

from tertulia.operators import bronze
from tertulia.plans.bronze import posts_from_pages

HOST = "https://forum.example"


def page(*posts):
    return json.dumps({"data": {"children": [{"data": p} for p in posts]}})


def pages(spark, *values):
    return spark.createDataFrame([(f"p{n}", v) for n, v in enumerate(values)], "source_file string, value string")


def test_missing_levels_give_no_rows(spark):
    raw = pages(spark, "{}", '{"data": {}}', '{"data": {"children": []}}', "garbage", page({"title": "a"}))
    assert [(r.source_file, r.pos, r.title) for r in bronze.flatten_api(raw, keep=["source_file"]).collect()] == [("p4", 0, "a")]


def test_pinned(spark):
    raw = pages(spark, page({"title": "a", "pinned": True}, {"title": "b", "pinned": None}, {"title": "c"},
                            {"title": "d", "pinned": False}))
    assert [r.title for r in bronze.drop_pinned(bronze.flatten_api(raw)).collect()] == ["b", "c", "d"]


def test_combined_length_is_stripped(spark):
    rows = [("a" * 9, "b" * 9), ("a" * 9, "b" * 10), ("  ", "c" * 20), (None, "d" * 19), ("e" * 20, None)]
    df = spark.createDataFrame(rows, "title string, selftext string")
    kept = bronze.min_combined_length(df).collect()
    assert [(r.title, r.selftext) for r in kept] == [rows[1], rows[2], rows[4]]


def test_keyword_in_title_or_body(spark):
    df = spark.createDataFrame([("El CONGRESO", None), (None, "leyenda"), ("nada", "aqui")], "title string, selftext string")
    assert bronze.keyword_filter(df).count() == 2


def test_projection_defaults(spark):
    raw = pages(spark, page({"permalink": "/r/1", "created_utc": 1775572994.0}))
    row = bronze.project_post(bronze.flatten_api(raw), HOST, "forum", "20260101_000000").first()
    assert row.asDict() == {
        "title": "", "text": "", "author": "", "date": 1775572994.0, "score": 0,
        "url": HOST + "/r/1", "source": "forum", "ingested_at": "20260101_000000"}


def test_first_twenty_matches_per_pull(spark):
    posts = [{"title": f"el congreso vota hoy numero {n}" if n % 2 else "nada que ver con el tema de hoy"} for n in range(44)]
    raw = pages(spark, page(*posts), page(*posts[:3]))
    got = posts_from_pages(raw, HOST, "forum", "x").groupBy("source_file").agg(
        F.count("*").alias("n"), F.max("pos").alias("last")).orderBy("source_file").collect()
    assert [(r.n, r.last) for r in got] == [(20, 39), (1, 1)]


def test_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS b", "id AS pos")
    plan = bronze.first_n_per_batch(df, ["b"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_missing_key_differs_from_null(spark):
    text = '[{"title": "a", "author": null, "url": "u", "source": "s", "date": 1}, {"title": "  ", "url": "u"}, {"author": "x"}]'
    records = spark.createDataFrame([(text,)], "value string").select(
        F.explode(F.from_json("value", "array<map<string,string>>")).alias("record"))
    checked = bronze.validate(records, bronze.POST_KEYS, "title").withColumn("source", F.lit("forum"))
    assert [(r.missing, r.empty_title) for r in checked.collect()] == [
        ([], False), (["author", "date", "source"], True), (["date", "source", "title", "url"], True)]
    assert bronze.validation_summary(checked).first().asDict() == {"source": "forum", "records": 3, "warnings": 4}


def test_untitled_link_still_counts_as_seen(spark):
    rows = [(0, "u1", ""), (1, "u1", "later"), (2, "u2", "b"), (3, "u2", "c"), (4, "", "d"), (5, None, "e")]
    got = bronze.first_seen_url(spark.createDataFrame(rows, "n int, url string, title string"), ["n"]).collect()
    assert [(r.url, r.title) for r in got] == [("u2", "b")]


def test_enrich(spark):
    listing = spark.createDataFrame(
        [("u1", "t1", "a", "e", ""), ("u2", "t2", "b", "", ""), ("u3", "t3", "c", "", "")],
        "url string, titulo string, etiquetas string, extracto string, contenido string")
    detail = spark.createDataFrame([("u1", "cuerpo", "x, y"), ("u2", "z" * 400, "")],
                                   "url string, contenido string, etiquetas string")
    got = {r.url: (r.titulo, r.etiquetas, r.extracto, r.contenido) for r in bronze.enrich_detail(listing, detail).collect()}
    assert got == {"u1": ("t1", "x, y", "e", "cuerpo"), "u2": ("t2", "b", "z" * 300, "z" * 400), "u3": ("t3", "c", "", "")}


def test_scraped_batch(spark):
    df = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abcd"), (3, "v", "abcd")], "n int, url string, titulo string")
    assert [r.url for r in bronze.scraped_batch_clean(df, ["n"]).collect()] == ["v"]
