"""First rows as streaming state, and silver from new files only, against the batch plans."""

import json

import pytest
from pyspark.sql import functions as F

from tertulia.plans import incremental, silver
from tertulia.plans.kinds import ARTICLES, POSTS
from tertulia.sources import buckets, runs
from tertulia.sources.json_batches import read_json_batches
from tertulia.streaming import first_rows, ingest


def post(n, score, title=None, text="un texto bastante largo"):
    return {"title": title or f" Título {n} ", "text": text, "author": None, "date": 1775572994.0 + n, "score": score, "url": f"https://forum.example/{n}"}


def article(n, body="crisis en el congreso y en la plaza, " * 3, title=None):
    return {"titulo": title or f"Nota {n} ", "autor": "luz", "fecha": "2026-04-26T21:47:13-05:00", "url": f"https://news.example/{n}",
            "extracto": "", "etiquetas": "", "contenido": body, "fuente": "news"}


# The third arrival is late: its name, and so its records, stand before the others.
POST_PULLS = {
    "posts_2.json": [post(1, 5), post(2, "abc"), post(1, 7), post(9, 4, text="corto")],
    "posts_3.json": [post(1, 9), post(3, 6), post(4, 4), post(1, 8, title="otro título")],
    "posts_1.json": [post(3, 1), post(3, 2), post(5, 5)],
    "posts_4.json": [],
    "posts_5.json": [post(6, 900), post(2, 3)],
}
ARTICLE_PULLS = {
    "articles_2.json": [article(1), article(1, title="Otra nota"), article(2, "corto")],
    "articles_1.json": [article(2), article(3)],
    "articles_3.json": [article(1), article(4), {"titulo": None, "url": None}],
}
KINDS = [(POSTS, POST_PULLS, silver.process_posts), (ARTICLES, ARTICLE_PULLS, silver.process_articles)]


def land(folder, name, records, lines):
    folder.mkdir(exist_ok=True)
    text = "\n".join(map(json.dumps, records)) if lines else json.dumps(records, indent=4)
    (folder / name).write_text(text, encoding="utf-8")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(("kind", "pulls", "process"), KINDS, ids=["posts", "articles"])
@pytest.mark.parametrize("lines", [True, False], ids=["lines", "arrays"])
def test_stream_equals_batch_after_every_arrival(spark, tmp_path, kind, pulls, process, lines):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    glob, source = f"{kind.name}_*.json", ingest.line_stream if lines else ingest.array_stream
    provider = spark.conf.get(first_rows.PROVIDER)
    sizes = []
    for name, records in pulls.items():
        land(folder, name, records, lines)
        first_rows.ingest_first(source(spark, str(folder), glob, kind.schema), kind, out, checkpoint).awaitTermination()
        batch = process(read_json_batches(spark, str(folder), glob, kind.schema, lines))
        assert rows(first_rows.silver_table(spark, out, kind)) == rows(batch)
        sizes.append(spark.read.parquet(out).count())
    # A restart without new files replays nothing, and the store of other queries is as before.
    first_rows.ingest_first(source(spark, str(folder), glob, kind.schema), kind, out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == sizes[-1] and spark.conf.get(first_rows.PROVIDER) == provider
    # The late file replaced a row; the settled table holds each key once.
    appended = spark.read.parquet(out)
    assert appended.where("replaces IS NOT NULL").count() == 1
    assert first_rows.settled(appended).groupBy("key").count().where("count > 1").isEmpty()


@pytest.mark.parametrize(("kind", "pulls", "process"), KINDS, ids=["posts", "articles"])
def test_silver_reads_new_files_only(spark, tmp_path, kind, pulls, process):
    folder, path, glob = tmp_path / "in", str(tmp_path / "table"), f"{kind.name}_*.json"
    for k, (name, records) in enumerate(pulls.items()):
        land(folder, name, records, lines=False)
        done = incremental.refresh(spark, str(folder), glob, path, f"run{k}", kind, n_buckets=8)
        assert [f.rsplit("/", 1)[1] for f in done["files"]] == [name]
        batch = process(read_json_batches(spark, str(folder), glob, kind.schema))
        table = incremental.silver_table(spark, path, kind)
        assert rows(table) == rows(batch)
        assert not any(".json" in f for f in table.inputFiles())
        owners = buckets.owners(spark, path)
        assert {b for b, run in owners.items() if run == f"run{k}"} == set(done["buckets"])
    assert 0 < len(done["buckets"]) < 8  # the last arrival left other buckets alone
    assert incremental.refresh(spark, str(folder), glob, path, "run9", kind) == {"files": [], "buckets": []}


def test_second_run_plans_no_old_file(spark, tmp_path, monkeypatch):
    folder, path = tmp_path / "in", str(tmp_path / "table")
    land(folder, "posts_1.json", POST_PULLS["posts_2.json"], False)
    incremental.refresh(spark, str(folder), "posts_*.json", path, "run0", POSTS, n_buckets=8)
    seen, read = [], incremental.json_batches.read_json_files
    monkeypatch.setattr(incremental.json_batches, "read_json_files", lambda *a: seen.append(read(*a)) or seen[-1])
    land(folder, "posts_2.json", POST_PULLS["posts_3.json"], False)
    incremental.refresh(spark, str(folder), "posts_*.json", path, "run1", POSTS, n_buckets=8)
    assert [f.rsplit("/", 1)[1] for df in seen for f in df.inputFiles()] == ["posts_2.json"]
    with pytest.raises(ValueError, match="committed already"):
        incremental.refresh(spark, str(folder), "posts_*.json", path, "run1", POSTS)


def test_copies_rewrite_no_bucket(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "table")
    land(folder, "posts_1.json", POST_PULLS["posts_2.json"], False)
    incremental.refresh(spark, str(folder), "posts_*.json", path, "run0", POSTS, n_buckets=8)
    land(folder, "posts_2.json", POST_PULLS["posts_2.json"], False)
    assert incremental.refresh(spark, str(folder), "posts_*.json", path, "run1", POSTS, n_buckets=8)["buckets"] == []


def test_a_failed_run_leaves_the_table_and_is_made_up_for(spark, tmp_path, monkeypatch):
    folder, path = tmp_path / "in", str(tmp_path / "table")
    land(folder, "posts_1.json", POST_PULLS["posts_2.json"], False)
    incremental.refresh(spark, str(folder), "posts_*.json", path, "run0", POSTS, n_buckets=8)
    before = rows(incremental.silver_table(spark, path, POSTS))
    land(folder, "posts_2.json", POST_PULLS["posts_3.json"], False)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(runs, "write_run", fail)
        with pytest.raises(RuntimeError):
            incremental.refresh(spark, str(folder), "posts_*.json", path, "run1", POSTS, n_buckets=8)
    assert rows(incremental.silver_table(spark, path, POSTS)) == before
    incremental.refresh(spark, str(folder), "posts_*.json", path, "run2", POSTS, n_buckets=8)
    batch = silver.process_posts(read_json_batches(spark, str(folder), "posts_*.json", POSTS.schema))
    assert rows(incremental.silver_table(spark, path, POSTS)) == rows(batch)


def test_nothing_taken_yet(spark, tmp_path):
    assert incremental.silver_table(spark, str(tmp_path / "none"), POSTS).count() == 0


def test_runs_are_whole_or_not_there(spark, tmp_path):
    path = str(tmp_path / "table")
    docs = spark.range(100).withColumn("lang", F.concat(F.lit("l "), (F.col("id") % 4).cast("string")))
    assert runs.read_newest(spark, path) is None and runs.committed(spark, path).isEmpty()
    runs.write_run(docs.where("id < 60"), path, "run_a", "lang")
    runs.write_run(docs, path, "run_b", "lang")
    docs.limit(7).write.parquet(f"{path}/run=run_c")  # never committed
    got = {r.run: (r.files > 0, r.rows) for r in runs.committed(spark, path).collect()}
    assert got == {"run_a": (True, 60), "run_b": (True, 100)}
    newest = runs.read_newest(spark, path, "run")
    assert newest.count() == 100 and newest.columns == ["id", "run", "lang"] and newest.select("run").distinct().count() == 1
    assert runs.read_newest(spark, path).count() == 100
    assert runs.read_runs(spark, path, ["run_a", "run_b"]).groupBy("run").count().orderBy("run").collect() == [("run_a", 60), ("run_b", 100)]
    # Rows that were added to a run after its commit, or lost from it, are found out.
    docs.limit(3).write.mode("append").partitionBy("lang").parquet(f"{path}/run=run_b")
    with pytest.raises(runs.BrokenRun, match="run_b"):
        runs.read_newest(spark, path, "run")
    runs.write_run(docs.limit(5), path, "run_b", "lang")
    assert runs.read_newest(spark, path, "run").count() == 5
