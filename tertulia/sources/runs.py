"""Runs that are committed as a whole: a manifest per run, written last.

A run is everything below a folder `run=<name>` of a table, however deep it is partitioned. After its
files are written, `commit` lists them with their row counts into `_runs/<run>` beside
them (readers of the table pass over names that start with an underscore). A run without a
manifest is still being written, or failed, and is no run to any reader here; a run whose
files are not those of its manifest is refused. The driver learns the names of runs, never of files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "run string, file string, bytes long, rows long, committed timestamp"


class BrokenRun(ValueError):
    """A committed run has lost, gained or changed files."""


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_runs"


def _place(path: str) -> tuple[Column, Column]:
    """run and file of a row's file: the folder below `path`, and what lies below that."""
    below = F.substring_index(F.col("_metadata.file_path"), f"/{path.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    folder = F.substring_index(below, "/", 1)
    return F.substring_index(folder, "run=", -1).alias("run"), F.substring(below, F.length(folder) + 2, F.length(below)).alias("file")


def _folders(path: str, runs: Sequence[str]) -> list[str]:
    return [f"{path.rstrip('/')}/run={run}" for run in runs]


def run_files(spark: SparkSession, path: str, runs: Sequence[str]) -> DataFrame:
    """run, file (below the run's folder) and bytes of what lies there now."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(_folders(path, runs)).select(*_place(path), F.col("length").alias("bytes"))


def commit(spark: SparkSession, path: str, run: str) -> None:
    """Make the run one that readers see. Committing again replaces its manifest."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(*_folders(path, [run])).groupBy(*_place(path)).agg(F.count(F.lit(1)).alias("rows"))
    manifest = run_files(spark, path, [run]).join(rows, ["run", "file"], "left").select(
        "run", "file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), F.current_timestamp().alias("committed"))
    manifest.write.mode("overwrite").parquet(f"{_manifests(path)}/{run}")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file of each committed run; empty where nothing was committed."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(_manifests(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise


def committed(spark: SparkSession, path: str) -> DataFrame:
    """run, files, rows, committed, of every run that is whole."""
    return manifests(spark, path).groupBy("run").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.max("committed").alias("committed"))


def _check(spark: SparkSession, path: str, runs: Sequence[str]) -> None:
    listed = manifests(spark, path).where(F.col("run").isin(list(runs))).select("run", "file", "bytes")
    odd = listed.withColumn("there", F.lit(-1)).unionByName(run_files(spark, path, runs).withColumn("there", F.lit(1))).groupBy(
        "run", "file", "bytes").agg(F.sum("there").alias("there")).where("there <> 0").take(3)
    if odd:
        raise BrokenRun(", ".join(sorted({f"{r.run}/{r.file}" for r in odd})))


def read_runs(spark: SparkSession, path: str, runs: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """The rows of these committed runs, with partition columns and `run`. Without a schema, one
    file's is taken for all."""
    _check(spark, path, runs)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", path).parquet(*_folders(path, runs)).withColumn("run", _place(path)[0])


def read_newest(spark: SparkSession, path: str, by: str = "committed", schema: StructType | None = None) -> DataFrame | None:
    """The committed run that is last, by time of commit (`by="committed"`) or by name
    (`by="run"`; of equal times the last by name); None where none is."""
    last = committed(spark, path).orderBy(F.desc(by), F.desc("run")).select("run").first()
    return read_runs(spark, path, [last.run], schema) if last else None


def withdraw(spark: SparkSession, path: str, run: str) -> None:
    """The run is no committed run until it is committed again."""
    spark.createDataFrame([], MANIFEST).write.mode("overwrite").parquet(f"{_manifests(path)}/{run}")


def write_run(df: DataFrame, path: str, run: str, *partitions: str) -> None:
    """Write and commit. A run written again replaces the one before it; while that is
    under way it is no committed run."""
    spark = df.sparkSession
    withdraw(spark, path, run)
    df.write.mode("overwrite").partitionBy(*partitions).parquet(*_folders(path, [run]))
    commit(spark, path, run)
