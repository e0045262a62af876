"""A table of the first row of each key, in hash buckets, into which new rows are merged.

A run compares the keys and places of its rows with those of the buckets they fall into (narrow
columns), and writes anew only buckets in which some row now comes first, into a folder of its own:

    rows/<run>/bucket=…/     the buckets that the run wrote
    buckets/                 per run, of every bucket the run that holds it; written last

Whole rows, old and new, are shuffled once, by their bucket, and written once. A written bucket
also holds the rows that were replaced in it, marked as such, until it is written again; so what a
run brought and what it replaced is read from its files.

The second folder is committed as a whole (`runs`), so a run that fails changes nothing. The driver
holds a number for each bucket, and the keys of which a run has more than `HOT` rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, StructField, StructType

from tertulia.operators.dedup import keep_first
from tertulia.sources import runs
from tertulia.sources.shared import written

BUCKETS = 256
#: Of a key with more rows than this in a run, one goes to its bucket from each task that reads some.
HOT = 10_000
#: What a row of a written bucket is to the run that wrote it; rows without a mark stayed.
MARK, STAYED, CAME, REPLACED = "_mark", 0, 1, 2


@dataclass(frozen=True)
class Merge:
    """Rows that come first now, those that did before in their place, and the buckets written."""

    winners: DataFrame
    replaced: DataFrame
    changed: list[int]
    owners: dict[int, str]


def is_committed(spark: SparkSession, path: str, run: str) -> bool:
    return not runs.committed(spark, f"{path}/buckets").where(F.col("run") == run).isEmpty()


def owners(spark: SparkSession, path: str) -> dict[int, str]:
    """Of every bucket the run whose folder holds it, as the last committed run says."""
    newest = runs.read_newest(spark, f"{path}/buckets", "run")
    return {r.bucket: r.owner for r in newest.collect()} if newest is not None else {}


def _folders(path: str, held: dict[int, str], buckets: Iterable[int]) -> list[str]:
    return [f"{path}/rows/{held[b]}/bucket={b}" for b in sorted(set(buckets) & set(held))]


def _marked(spark: SparkSession, folders: Sequence[str], schema: StructType | None) -> DataFrame:
    """All rows of these folders; `MARK` is null in those of tables that knew no marks."""
    if schema is None:
        schema = spark.read.parquet(*folders).drop(MARK).schema
    marked = StructType([*schema.fields, StructField(MARK, ByteType())])
    return spark.read.schema(marked).parquet(*folders) if folders else spark.createDataFrame([], marked)


def read(spark: SparkSession, path: str, held: dict[int, str], schema: StructType | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
    """The rows of these buckets, or of all; files of no others are listed or read."""
    rows = _marked(spark, _folders(path, held, held if buckets is None else buckets), schema)
    return rows.where(~F.col(MARK).eqNullSafe(F.lit(REPLACED))).drop(MARK)


def _in_buckets(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def merge(
    path: str, run: str, rows: DataFrame, key: str, order: Sequence[str], buckets: int = BUCKETS, long: Sequence[str] = (),
) -> Merge:
    """Merge rows into the table, of a key the first in `order` among them and those there. It
    counts once `commit` is called. The number of buckets is fixed by the first run.

    The rows are computed twice, the first time for the keys and `order` alone, so they have to be the
    same both times. `long` names columns at the end of `order` that are compared by a
    digest at first; a bucket that is written without need for it is not taken in."""
    spark, schema = rows.sparkSession, rows.schema
    rows, held = _in_buckets(rows, key, buckets), owners(spark, path)
    short = [c for c in order if c not in long]
    if list(order) != [*short, *long]:
        raise ValueError("long columns have to be the last of the order")
    place = [F.struct(F.lit(0), *short).alias("place"), F.xxhash64(F.lit(0), *long).alias("rest")]
    arrived = written(rows.select("bucket", key, *place).groupBy("bucket", key).agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("place"), F.min("rest").alias("least"), F.max("rest").alias("most")), "arrived", compression="zstd")
    touched = [r.bucket for r in arrived.select("bucket").distinct().collect()]
    there = read(spark, path, held, schema, touched).select(key, *place).withColumnsRenamed({"place": "_place", "rest": "_rest"})
    other = (F.col("least") != F.col("_rest")) | (F.col("most") != F.col("_rest"))
    first = F.col("_place").isNull() | (F.col("place") < F.col("_place")) | ((F.col("place") == F.col("_place")) & other)
    written_anew = sorted(r.bucket for r in arrived.join(there, key, "left").where(first).select("bucket").distinct().collect())
    rows = rows.where(F.col("bucket").isin(written_anew))
    hot = [r[0] for r in arrived.where(F.col("rows") > HOT).select(key).collect()]
    if hot:
        is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
        rows = rows.where(~is_hot).unionByName(keep_first(rows.where(is_hot), [key], order))
    changed, folder = [], f"{path}/rows/{run}"
    if written_anew:
        before = _in_buckets(read(spark, path, held, schema, written_anew), key, buckets)
        both = before.withColumn("_came", F.lit(False)).unionByName(rows.select(*before.columns).withColumn("_came", F.lit(True)))
        # Of equal places the row that is there stays. A bucket is one partition's worth by choice
        # of their number; its rows are sorted where they are written.
        at = F.row_number().over(Window.partitionBy("bucket", key).orderBy(*(F.col(c) for c in order), "_came"))
        mark = F.when(at > 1, REPLACED).when(F.col("_came"), CAME).otherwise(STAYED).cast("byte")
        ranked = both.repartition("bucket").select(*schema.names, "bucket", "_came", mark.alias(MARK))
        kept = ranked.where((F.col(MARK) != REPLACED) | ~F.col("_came")).drop("_came")
        kept.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(folder)
        came = spark.read.parquet(folder).where(F.col(MARK) == CAME).select("bucket").distinct()
        changed = sorted(r.bucket for r in came.collect())
    held = held | {b: run for b in changed}
    marked = _marked(spark, _folders(path, held, changed), schema)
    winners, replaced = (marked.where(F.col(MARK) == m).drop(MARK) for m in (CAME, REPLACED))
    return Merge(winners, replaced, changed, held)


def commit(spark: SparkSession, path: str, run: str, done: Merge) -> None:
    table = spark.createDataFrame(sorted(done.owners.items()), "bucket int, owner string")
    runs.write_run(table.coalesce(1), f"{path}/buckets", run)
