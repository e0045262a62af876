"""Parquet snapshots: a `run_ts=YYYYMMDD_HHMMSS` folder per run, or flat named files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUN_TS = "run_ts"
TS_PATTERN = r"(\d{8}_\d{6})"
TS_FORMAT = "yyyyMMdd_HHmmss"


def run_stamp(ts) -> str:
    return ts.strftime("%Y%m%d_%H%M%S")


def write_snapshot(df: DataFrame, path: str, run_ts: str) -> None:
    """Write one run as a partition. Writing a run again replaces that run only."""
    (df.withColumn(RUN_TS, F.lit(run_ts)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(RUN_TS).parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_snapshots(
    spark: SparkSession, path: str, glob: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """All snapshots as one table, with `source_file` for ordering."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path).withColumn("source_file_name", F.col("_metadata.file_name"))


def snapshot_listing(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """(path, name, modified, length) of files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option(
        "recursiveFileLookup", True).load(path)
    return files.select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        F.col("modificationTime").alias("modified"), "length")


def _run_of(path: str = "path") -> Column:
    """What was written as one: the folder of a run stamp, else the folder that the partition
    folders (`column=value`) of files that tasks wrote lie in, else the file itself."""
    stamped = F.regexp_extract(path, rf"^(.*/{RUN_TS}=[^/]+)/", 1)
    folder = F.regexp_extract(path, r"^(.*?)(/[^/=]+=[^/]*)*/part-[^/]+$", 1)
    return F.coalesce(F.nullif(stamped, F.lit("")), F.nullif(folder, F.lit("")), F.col(path))


def latest_by_mtime(listing: DataFrame) -> DataFrame:
    """All files of the run that was modified last; of equal times, the last by path."""
    runs = listing.withColumn("_run", _run_of())
    newest = runs.agg(F.max(F.struct("modified", "_run"))["_run"].alias("run")).scalar()
    return runs.where(F.col("_run") == newest).drop("_run")


def latest_by_name_ts(listing: DataFrame, mart: str | None = None) -> DataFrame:
    """Files of the newest run by the timestamp in their path, else by modification time.

    With `mart`, only `<mart>_<timestamp>` names count, so that a mart whose name starts
    with another's is not mixed up with it.
    """
    if mart is not None:
        listing = listing.where(F.col("name").rlike(rf"^\Q{mart}\E(_\d{{8}}_\d{{6}})?\."))
    stamped = listing.withColumn(
        "ts", F.try_to_timestamp(F.nullif(F.regexp_extract("path", TS_PATTERN + r"[^\d]*[^/]*(/[^/]*)?$", 1), F.lit("")),
                                 F.lit(TS_FORMAT)))
    top = stamped.agg(F.max("ts").alias("ts"), F.max("modified").alias("modified"))
    newest, modified = top.select("ts").scalar(), top.select("modified").scalar()
    return stamped.where(
        F.when(newest.isNotNull(), F.col("ts") == newest).otherwise(F.col("modified") == modified))


def read_latest_run(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest `run_ts`, found from the listing; other partitions are not read."""
    runs = snapshot_listing(spark, path).select(F.regexp_extract("path", RUN_TS + "=" + TS_PATTERN, 1).alias(RUN_TS))
    return read_snapshots(spark, path).where(F.col(RUN_TS) == runs.agg(F.max(RUN_TS)).scalar())


def read_files(spark: SparkSession, files: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Read the files of a chosen run.

    A run folder is read by its own path, however many files it holds and however they are
    partitioned, so the driver receives a path per run folder or flat snapshot file only. For
    runs that may still be written, or were written to twice, see `runs`.
    """
    roots = files.select(_run_of().alias("root")).distinct()
    paths = [r.root for r in roots.collect()]
    if not paths:
        if schema is None:
            raise FileNotFoundError("no snapshot and no schema for an empty table")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)
