"""JSON batches: one file per pull, an array of records or one record per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Everything is read as text: a bad number must reach the lenient conversion in silver.
POSTS = _strings("title", "text", "author", "date", "score", "url", "source", "ingested_at")
ARTICLES = _strings(
    "titulo", "autor", "fecha", "url", "extracto", "etiquetas", "contenido", "fuente", "ingested_at")


def record_position() -> Column:
    """Order of records within a file: split offset, then reading order within the task.

    A file with an array is read by one task; a JSON Lines file may be split, and a
    split starts at a higher offset than the one before it.
    """
    return F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


DAMAGED = "damaged"


def with_damaged(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(DAMAGED, StringType())])


def read_json_batches(
    spark: SparkSession, folder: str, glob: str, schema: StructType, lines: bool = False, fail_fast: bool = False
) -> DataFrame:
    """Every record of the files matching `glob`, with `source_file` and `pos`.

    (`source_file`, `pos`) is the order in which sorted files hold their records. The
    schema is fixed, so empty batches give an empty typed table. What can't be read (a
    line, or a whole array file that was cut off) is one row without fields, its text in
    `damaged`; see `damaged_records`. With `fail_fast` it ends the job instead.
    """
    reader = _reader(spark, schema, lines, fail_fast).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return _with_place(reader.json(folder))


def read_json_files(
    spark: SparkSession, files: Sequence[str], schema: StructType, lines: bool = False, fail_fast: bool = False
) -> DataFrame:
    """The same of these files alone; an empty typed table of none."""
    if not files:
        empty = StructType([*with_damaged(schema).fields, StructField("source_file", StringType()),
                            StructField("pos", StructType([StructField("block", LongType()), StructField("row", LongType())]))])
        return spark.createDataFrame([], empty)
    return _with_place(_reader(spark, schema, lines, fail_fast).json(list(files)))


def _reader(spark: SparkSession, schema: StructType, lines: bool, fail_fast: bool) -> DataFrameReader:
    return (
        spark.read.schema(with_damaged(schema)).option("multiLine", not lines)
        .option("mode", "FAILFAST" if fail_fast else "PERMISSIVE").option("columnNameOfCorruptRecord", DAMAGED))


def _with_place(batches: DataFrame) -> DataFrame:
    return batches.withColumn("source_file", F.col("_metadata.file_name")).withColumn("pos", record_position())


def damaged_records(batches: DataFrame, first: str = "url") -> DataFrame:
    """(source_file, records, damaged) of every file; `first` is any column of the records.

    The reader finds damage only where it reads fields too, hence that column."""
    return batches.groupBy("source_file").agg(
        F.count_if(F.col(first).isNotNull() | F.col(DAMAGED).isNull()).alias("records"),
        F.count_if(F.col(DAMAGED).isNotNull()).alias("damaged"))


def read_raw_records(spark: SparkSession, folder: str, glob: str, lines: bool = False) -> DataFrame:
    """Each record as `map<string,string>`, in which an absent key differs from a null.

    A line or a file that can't be read is one row with a null `record`, which lacks every
    key, and its text in `damaged`.

    An array file is one pull of at most some dozen records and is held in one row;
    large data is kept as lines, where a row is a record.
    """
    text = spark.read.text(folder, wholetext=not lines, pathGlobFilter=glob, recursiveFileLookup=True)
    file = F.col("_metadata.file_name").alias("source_file")
    if lines:
        return text.where("trim(value) <> ''").select(file, "value", F.from_json("value", "map<string,string>").alias("record")).select(
            "source_file", "record", F.when(F.col("record").isNull(), F.col("value")).alias(DAMAGED))
    parsed = F.from_json("value", "array<map<string,string>>")
    rows = text.select(file, "value", parsed.isNull().alias("bad"), F.posexplode_outer(parsed).alias("pos", "record"))
    # A file without records is no damage, an unread one is.
    damaged = F.col("bad") & (F.trim("value") != "")
    return rows.where(F.col("pos").isNotNull() | damaged).select(
        "source_file", "pos", "record", F.when(damaged, F.col("value")).alias(DAMAGED))


def read_raw_pages(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """One row per landed API page: `source_file`, `value`."""
    text = spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return text.select(F.col("_metadata.file_name").alias("source_file"), "value")


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines, UTF-8, accents as they are."""
    df.write.mode(mode).json(path)
