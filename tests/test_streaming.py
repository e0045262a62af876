import json

from tertulia.plans.silver import process_posts
from tertulia.sources.json_batches import POSTS, read_json_batches
from tertulia.streaming import ingest


def record(n, url, score, text="un texto bastante largo"):
    return {"title": f" Título {n} ", "text": text, "author": None, "date": 1775572994.0 + n, "score": score, "url": url}


PULLS = [
    [record(1, "https://1", 5), record(2, "https://2", "abc"), record(1, "https://1", 7)],
    [record(1, "https://1", 9), record(3, "https://3", 6, "corto"), record(4, "https://4", 4)],
    [],
    [record(5, "https://5", 5), record(6, "https://6", 900), record(3, "https://3", 6)],
]


def rows(df):
    return sorted(map(str, df.collect()))


def drain(spark, source, folder, out, checkpoint):
    ingest.ingest_available(source(spark, folder, "posts_*.json"), out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def run(spark, tmp_path, source, lines):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    (tmp_path / "in").mkdir()
    counts = []
    for n, pull in enumerate(PULLS):
        text = "\n".join(map(json.dumps, pull)) if lines else json.dumps(pull, indent=4)
        (tmp_path / "in" / f"posts_{n}.json").write_text(text, encoding="utf-8")
        counts.append(drain(spark, source, folder, out, checkpoint).count())
    # A run without new files adds nothing.
    counts.append(drain(spark, source, folder, out, checkpoint).count())
    assert counts == [3, 6, 6, 9, 9]
    batch = process_posts(read_json_batches(spark, folder, "posts_*.json", POSTS, lines=lines))
    settled = ingest.settle(spark.read.parquet(out))
    assert rows(settled) == rows(batch)
    # The outlier and the short first copy's whole key are gone; first scores win.
    assert {(r.url, r.score) for r in settled.collect()} == {
        ("https://1", 5), ("https://2", 0), ("https://4", 4), ("https://5", 5)}


def test_arrays(spark, tmp_path):
    run(spark, tmp_path, ingest.array_stream, lines=False)


def test_lines(spark, tmp_path):
    run(spark, tmp_path, ingest.line_stream, lines=True)
