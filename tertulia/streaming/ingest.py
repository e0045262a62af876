"""Silver posts over newly arriving files.

Row-wise work (typing, filling, cleaning) runs in the stream. The dedupe pick and the
score fence depend on every record so far, so they run as a batch step over the
appended table; a streaming dedupe by url would need state without end.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tertulia.functions.wordlists import STOPWORDS
from tertulia.operators import silver
from tertulia.operators.dedup import keep_first
from tertulia.sources.json_batches import DAMAGED, POSTS, with_damaged


def array_stream(
    spark: SparkSession, folder: str, glob: str, schema: StructType = POSTS, files_per_trigger: int = 1000
) -> DataFrame:
    """Records of array files as they arrive, with `source_file` and `pos`. A file that can't be
    read is one row without fields, its text in `damaged`."""
    files = (
        spark.readStream.format("text").option("wholetext", True)
        .option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger).load(folder)
    )
    records = F.from_json("value", f"array<{schema.simpleString()}>")
    rows = files.select(
        F.col("_metadata.file_name").alias("source_file"), F.when(records.isNull() & (F.trim("value") != ""), F.col("value")).alias(DAMAGED),
        F.posexplode_outer(records).alias("row", "r"))
    return rows.where(F.col("row").isNotNull() | F.col(DAMAGED).isNotNull()).select(
        "r.*", "source_file", DAMAGED, F.lit(0).cast("bigint").alias("block"), F.col("row").cast("bigint").alias("row"))


def line_stream(
    spark: SparkSession, folder: str, glob: str, schema: StructType = POSTS, files_per_trigger: int = 1000
) -> DataFrame:
    """Records of JSON Lines files as they arrive; large files are split over tasks."""
    return (
        spark.readStream.schema(with_damaged(schema)).option("columnNameOfCorruptRecord", DAMAGED)
        .option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger).json(folder)
        .withColumns({"source_file": F.col("_metadata.file_name"), "block": F.col("_metadata.file_block_start")})
    )


def clean_rows(posts: DataFrame, stopwords: Iterable[str] = STOPWORDS, keep: Sequence[str] = ()) -> DataFrame:
    """Row-wise silver steps. `key_title` keeps the raw title, the key of the later dedupe."""
    keyed = posts.withColumn("key_title", F.col("title"))
    filled = silver.fill_defaults(silver.coerce_posts(keyed), silver.POST_DEFAULTS)
    return silver.add_clean(silver.strip_columns(filled, ["title"]), ["title", "text"], stopwords).select(
        *silver.POST_COLUMNS, "key_title", "pos", *([DAMAGED] if DAMAGED in posts.columns else []), *keep)


def ingest_available(
    stream: DataFrame, path: str, checkpoint: str, stopwords: Iterable[str] = STOPWORDS, keep: Sequence[str] = ()
) -> StreamingQuery:
    """Clean and append what has arrived since the last run, then stop.

    Each micro-batch overwrites a folder of its own, so a batch replayed after a failure
    leaves its rows once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        row = F.col("row") if "row" in batch.columns else F.monotonically_increasing_id()
        placed = batch.withColumn("pos", F.struct(F.col("block"), row.alias("row")))
        clean_rows(placed, stopwords, keep).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).start()
    )


def settle(appended: DataFrame, order: Sequence[str] = ("source_file", "pos")) -> DataFrame:
    """The silver table of everything appended: first per (url, raw title), filters, fence."""
    first = keep_first(appended, ["url", "key_title"], order)
    valid = silver.min_length_filters(first, silver.POST_MIN_CHARS)
    return silver.select_silver(silver.iqr_upper_fence(valid), silver.POST_COLUMNS)
