"""Snapshots in buckets of a key, so that work by that key over many runs needs no shuffle.

Every run is appended to one table, partitioned by run and bucketed and sorted by the key. Files
of a bucket from all runs are read by one task, so a dedupe by the key, and a join of two such
tables with equal buckets, find their rows where they were read. The number of buckets is fixed
with the table; choose it so that a bucket over all runs that are read together is one task's work.

Spark keeps the layout in its catalog. The files lie under `path`, which `register` makes known
to a session whose catalog has not seen the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tertulia.sources.snapshots import RUN_TS

BUCKETS = 256


def append_run(df: DataFrame, table: str, path: str, run_ts: str, key: str = "url", buckets: int = BUCKETS) -> None:
    """Add a run. One task writes each bucket, so a run has one sorted file per bucket."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and not spark.table(table).where(F.col(RUN_TS) == run_ts).isEmpty():
        raise ValueError(f"{run_ts} is in {table} already")
    rows = df.withColumn(RUN_TS, F.lit(run_ts)).repartition(buckets, key)
    (rows.write.format("parquet").mode("append").option("path", path).partitionBy(RUN_TS)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def register(spark: SparkSession, table: str, path: str, schema: str, key: str = "url", buckets: int = BUCKETS) -> None:
    """Make a table that lies under `path` known again. `schema` lists its columns, without the run's."""
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {table} ({schema}, {RUN_TS} STRING) USING parquet PARTITIONED BY ({RUN_TS})
        CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'""")
    spark.sql(f"MSCK REPAIR TABLE {table}")


def read_runs(spark: SparkSession, table: str, since: str | None = None) -> DataFrame:
    """All runs, or those from a stamp on; files of no others are read."""
    rows = spark.table(table)
    return rows if since is None else rows.where(F.col(RUN_TS) >= since)
