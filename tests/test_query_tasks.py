"""Queries that deal their input to more tasks as it grows."""

import glob
import os

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def test_the_newest_run_is_written_by_as_many_tasks_as_read_it(spark):
    base, before = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir"), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    split = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1"}
    folder = f"{base}/many-documents"
    os.makedirs(folder)
    docs.repartition(12).write.parquet(f"{folder}/documents.parquet")
    for k, v in split.items():
        before[k] = spark.conf.get(k)
        spark.conf.set(k, v)
    try:
        n = spark.read.parquet(f"{folder}/documents.parquet").rdd.getNumPartitions()
        assert n >= 12 and queries()["latest_by_mtime"](spark, folder).count() == docs.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    newest = max(glob.glob(f"{base}/mtime-*"), key=os.path.getmtime)
    parts = {os.path.basename(f)[:10] for f in glob.glob(f"{newest}/second/*/part-*")}
    assert len(parts) > 4
