"""Silver that reads new bronze files only.

A settled table (`sources.buckets`) holds the first record of each key, typed, and knows which
bronze files it has taken. A run lists bronze, reads the files that are not among the taken ones,
and merges their first records. `taken/<run>/` lists the files that it read; it counts from the
moment the table's buckets are committed. A run that fails before leaves the table as it was,
and its files are read again by the next. The driver holds a name for each new file.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tertulia.functions.wordlists import STOPWORDS
from tertulia.plans.kinds import Kind
from tertulia.sources import buckets, json_batches, runs
from tertulia.sources.shared import written

FILES = "path string, length long, modified timestamp, run string"
#: Where a record stands among all: its file by name, then its place in it.
ORDER = ("source_file", "pos")


def bronze_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """path, length and modified of the bronze files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def taken(spark: SparkSession, path: str) -> DataFrame:
    """The bronze files of all runs that counted."""
    done = runs.committed(spark, f"{path}/buckets").select("run")
    try:
        files = spark.read.schema(FILES).option("recursiveFileLookup", True).parquet(f"{path}/taken")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], FILES)
    return files.join(done, "run", "left_semi")


def new_files(spark: SparkSession, bronze: str, glob: str, path: str) -> DataFrame:
    """The files that are there and were not taken; a file that was written over counts as new."""
    return bronze_files(spark, bronze, glob).join(taken(spark, path), ["path", "length", "modified"], "left_anti")


def _beside(kind: Kind, order: Sequence[str]) -> list[str]:
    """What settled rows hold beside the columns of silver."""
    return ["key", *(c for c in order if c not in kind.columns)]


def refresh(
    spark: SparkSession, bronze: str, glob: str, path: str, run: str, kind: Kind, lines: bool = False, n_buckets: int = buckets.BUCKETS,
    order: Sequence[str] = ORDER, stopwords: Iterable[str] = STOPWORDS,
) -> dict[str, list]:
    """Take in what has arrived as the run `run` (names sort by time). Returns the files read
    and the buckets written; both are empty where nothing is new.

    The number of buckets is fixed by the first run of a table."""
    if buckets.is_committed(spark, path, run):
        raise ValueError(f"{run} is committed already")
    # What is listed is what counts as taken, whatever happens to the files meanwhile.
    arrived = written(new_files(spark, bronze, glob, path).withColumn("run", F.lit(run)), "arrived")
    files = sorted(r.path for r in arrived.select("path").collect())
    if not files:
        return {"files": [], "buckets": []}
    raw = json_batches.read_json_files(spark, files, kind.schema, lines)
    keyed = raw.where("damaged IS NULL").drop("damaged").withColumn("key", kind.key())
    done = buckets.merge(path, run, kind.typed(keyed, _beside(kind, order), stopwords), "key", order, n_buckets)
    arrived.write.mode("overwrite").parquet(f"{path}/taken/{run}")
    buckets.commit(spark, path, run, done)
    return {"files": files, "buckets": done.changed}


def settled(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """The first record of each key of all files taken, typed, with key and place."""
    held = buckets.owners(spark, path)
    if not held:
        return kind.typed(json_batches.read_json_files(spark, [], kind.schema, True).withColumn("key", kind.key()), _beside(kind, ORDER))
    return buckets.read(spark, path, held)


def silver_table(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """Silver of all files taken, without reading any of them."""
    return kind.silver(settled(spark, path, kind))
