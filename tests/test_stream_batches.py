from tertulia.plans.kinds import POSTS
from tertulia.streaming import first_rows, ingest


def test_records_are_sent_to_the_stream_few_at_a_time(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0.json").write_text('{"title": "t", "url": "u", "text": "x"}\n')
    try:
        spark.conf.set(key, "10000")
        stream = ingest.line_stream(spark, str(tmp_path / "in"), "part-*.json", POSTS.schema)
        first_rows.ingest_first(stream, POSTS, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert int(spark.conf.get(key)) == first_rows.BATCH_ROWS and spark.read.parquet(str(tmp_path / "out")).count() == 1
    finally:
        spark.conf.set(key, before)
