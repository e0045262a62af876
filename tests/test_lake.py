import json

import pytest

from tertulia.plans import lake
from tertulia.sources.snapshots import read_latest_run


def post(n, text="el gobierno celebra la reforma", **more):
    return {"title": f"Título {n}", "text": text, "author": "ana", "date": 1775572994.0 + n * 86400, "score": n,
            "url": f"https://forum.example/{n}", "source": "forum", "ingested_at": "x", **more}


def article(n):
    return {"titulo": f"Nota {n}", "autor": "luz", "fecha": "2026-04-26T21:47:13-05:00", "url": f"https://news.example/{n}",
            "extracto": "", "etiquetas": "", "contenido": "crisis y corrupción en el congreso " * 3, "fuente": "news"}


@pytest.fixture
def bronze(tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()

    def land(name, records):
        (folder / name).write_text(json.dumps(records, indent=4, ensure_ascii=False), encoding="utf-8")

    land("posts_20260501_000000.json", [post(1), post(2), post(3)])
    land("posts_20260502_000000.json", [post(1, score=99), post(4)])
    land("posts_20260503_000000.json", [])
    land("articles_20260501_000000.json", [article(1), article(1), article(2)])
    return str(folder)


def test_two_runs(spark, bronze, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    assert lake.refresh_gold(spark, silver, gold, "20260503_000000") == {}
    for run in ("20260503_000000", "20260504_000000"):
        assert set(lake.refresh_silver(spark, bronze, silver, run)) == {"posts", "articles"}
        paths = lake.refresh_gold(spark, silver, gold, run, False, "forum", "news")
    table = {r.source: r for r in read_latest_run(spark, paths["governance"]).collect()}
    assert {s: (r.total_records, r.duplicate_rate, r.computed_at) for s, r in table.items()} == {
        "forum": (4, 0.0, "20260504_000000"), "news": (2, 0.0, "20260504_000000")}
    dist = {(r.source, r.sentiment): r["count"] for r in read_latest_run(spark, paths["sentiment_dist"]).collect()}
    assert dist == {("forum", "positive"): 4, ("news", "negative"): 2}
    scores = {str(r.fecha): r.avg_score for r in read_latest_run(spark, paths["score_trend"]).collect()}
    assert scores == {"2026-04-08": 1.0, "2026-04-09": 2.0, "2026-04-10": 3.0, "2026-04-11": 4.0}
    # By default all runs count, every record once per run; the corpus still holds each url once.
    paths = lake.refresh_gold(spark, silver, gold, "20260505_000000", posts_source="forum", articles_source="news")
    table = {r.source: r for r in read_latest_run(spark, paths["governance"]).collect()}
    assert (table["forum"].total_records, table["forum"].duplicate_rate) == (8, 50.0)
    dist = {(r.source, r.sentiment): r["count"] for r in read_latest_run(spark, paths["sentiment_dist"]).collect()}
    assert dist == {("forum", "positive"): 4, ("news", "negative"): 2}


def test_one_source_only(spark, tmp_path):
    folder = tmp_path / "only"
    folder.mkdir()
    (folder / "articles_1.json").write_text(json.dumps([article(1)]), encoding="utf-8")
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    assert set(lake.refresh_silver(spark, str(folder), silver, "20260503_000000")) == {"articles"}
    paths = lake.refresh_gold(spark, silver, gold, "20260503_000000")
    assert [r.source for r in read_latest_run(spark, paths["governance"]).collect()] == ["articles"]
    assert read_latest_run(spark, paths["keywords"]).count() == 3
