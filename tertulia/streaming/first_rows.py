"""The first record of each key over arriving files, kept as streaming state.

State holds, per key, where the first record so far stands: its file, split and row. A key
that was not seen before sends its first record on. A record that stands before the one
in the state (a file that arrived late) is sent on too, with the place of the record it
replaces, so that the appended rows say by themselves which of them count: `settled` leaves
out the replaced ones. A key's later copies leave the state and the table alone, so that an
arrival costs what it brings and never a look at what came before.

The state lives in RocksDB on the executors and in the checkpoint folder: a restart goes on
after the last finished batch, and a batch that is repeated overwrites its own folder. Keys
are digests, so a state entry has a bounded size. Copies within an Arrow batch are dropped
before the shuffle; what is left of a hot key streams through its task, one row at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructField, StructType

from tertulia.functions.batches import bounded_batches
from tertulia.functions.wordlists import STOPWORDS
from tertulia.plans.kinds import Kind

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Records that are sent to Python at once: copies of a key are dropped among so many.
BATCH_ROWS = 1024
#: The order of records: their file by name, the split of it, the row of that.
PLACE = ("source_file", "block", "row")


def _rank(place: Iterable) -> tuple:
    """Comparable with nulls, which come first as they do in Spark."""
    return tuple((x is not None, x) for x in place)


class FirstRow(StatefulProcessor):
    """Sends on the first row of a key in `order`, and again whenever an earlier one comes."""

    def __init__(self, columns: Sequence[str], order: StructType) -> None:
        self.columns, self.order = list(columns), order

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", self.order)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.order.names
        best = min(rows, key=lambda r: _rank(r[c] for c in names))
        place, old = tuple(best[c] for c in names), self.first.get() if self.first.exists() else None
        if old is None or _rank(place) < _rank(old):
            self.first.update(place)
            yield Row(**{c: best[c] for c in self.columns}, replaces=None if old is None else Row(**dict(zip(names, old))))

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession):
    """State in RocksDB for the query that is started inside; other queries keep their store."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def first_rows(stream: DataFrame, key: str = "key", order: Sequence[str] = PLACE) -> DataFrame:
    """The rows of `stream` that were the first of their key when they came, with `replaces`:
    the place of the row that an earlier one takes the place of, else null."""
    places = StructType([StructField(c, stream.schema[c].dataType) for c in order])

    def one_each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            yield rows.sort_values(list(order), na_position="first").drop_duplicates([key])

    fewer = stream.mapInPandas(one_each, stream.schema)
    return fewer.groupBy(key).transformWithState(
        FirstRow(stream.columns, places), StructType([*stream.schema.fields, StructField("replaces", places)]), "Append", "None")


def _numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by reading order in their task, which reads a split from its start to its end."""
    n = 0
    for rows in frames:
        yield rows.assign(row=range(n, n + len(rows)))
        n += len(rows)


def arrivals(stream: DataFrame, kind: Kind, order: Sequence[str] = PLACE) -> DataFrame:
    """The records of a file stream (`ingest.line_stream`, `ingest.array_stream`) with key and
    place, which is three columns of the stream or others that the records hold. Damaged records have no fields and so one key; they are left out here."""
    if "row" in order and "row" not in stream.columns:
        stream = stream.withColumn("row", F.lit(0).cast("bigint"))
        stream = stream.mapInPandas(_numbered, stream.schema)
    return stream.where("damaged IS NULL").select(
        *dict.fromkeys([*kind.schema.names, "source_file", *order]), kind.key().alias("key"))


def ingest_first(
    stream: DataFrame, kind: Kind, path: str, checkpoint: str, order: Sequence[str] = PLACE, stopwords: Iterable[str] = STOPWORDS
) -> StreamingQuery:
    """Append the typed first records of what has arrived since the last run, then stop."""
    keep = ["key", *(c for c in order if c not in kind.columns), "replaces"]
    bounded_batches(stream.sparkSession, BATCH_ROWS)

    def write(batch: DataFrame, batch_id: int) -> None:
        kind.typed(batch, keep, stopwords).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    firsts = first_rows(arrivals(stream, kind, order), "key", order)
    with _rocksdb(stream.sparkSession):
        return firsts.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()


def settled(appended: DataFrame, order: Sequence[str] = PLACE) -> DataFrame:
    """The one row of each key that counts. Nothing is grouped: the few replaced rows go."""
    replaced = appended.where("replaces IS NOT NULL").select(F.col("key").alias("_key"), *(F.col(f"replaces.{c}").alias(f"_{c}") for c in order))
    same = F.col("key") == F.col("_key")
    for c in order:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return appended.join(replaced, same, "left_anti").drop("replaces")


def silver_table(spark: SparkSession, path: str, kind: Kind, order: Sequence[str] = PLACE) -> DataFrame:
    """Silver of everything that has arrived."""
    return kind.silver(settled(spark.read.parquet(path), order))
