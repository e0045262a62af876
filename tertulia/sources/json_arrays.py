"""Large JSON arrays, read by many tasks.

An array can't be cut just anywhere: whether a brace opens a record depends on every quote
before it. So the text is read in pieces that end at a closing brace, which Spark's text
reader splits at any byte, and scanned twice.

The first scan gives a transition for each block of a file that a task reads: for a block
that starts outside a string and for one that starts inside, where it ends, and how much
deeper in brackets. Transitions are composed in file order by two running sums over the
blocks (a row each): inside or outside is the parity of the quotes before, and the depth then
sums the matching one of each block's two figures. The second scan knows how each of its blocks
starts and so which pieces start and end a record. A record of one piece, which is every flat
one, is parsed where it was read; pieces of other records meet by the place of their first one,
also across blocks.

What isn't an array of objects that can all be read is damage: a file with a piece or a
record of that kind, or without a closing bracket, is left to the whole-file reader and comes back as
that returns it, one row with the text in `damaged`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tertulia.sources.json_batches import DAMAGED, read_json_files
from tertulia.sources.shared import shared_folder, written

#: So many blocks are sent to every task at most; more meet the pieces by a shuffle.
BROADCAST_BLOCKS = 200_000

#: What lies between staged records: a control character that JSON never holds unescaped.
_LINE = "\x1e"
_FILE, _PATH, _BLOCK, _ROW = (f"tertulia staged {x}" for x in ("file", "path", "block", "row"))

_ESCAPED = re.compile(r"\\.", re.DOTALL)


def _depth(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Every piece in reading order: path, block, row in its block, value, whether it is the
    end of the file, and before and after it the parity of quotes and both depths since the
    block's start (outside a string there, inside one)."""
    columns, waiting, at, row, state = ("path", "block", "final", "value"), None, None, 0, (0, 0, 0)

    def stepped(piece, tail):
        path, block, _, value = piece
        parts = _ESCAPED.sub("", value if tail else value + "}").split('"')
        here = (_depth("".join(parts[0::2])), _depth("".join(parts[1::2])))
        quotes, outside, inside = state
        after = ((quotes + len(parts) - 1) % 2, outside + here[quotes], inside + here[1 - quotes])
        return (path, block, row, value, tail, *state, *after)

    for batch in batches:
        for piece in zip(*(batch.column(c).to_pylist() for c in columns)):
            if waiting is not None:
                out = stepped(waiting, waiting[2] and piece[:2] != waiting[:2])
                yield out
                row, state = row + 1, out[-3:]
            if piece[:2] != at:
                at, row, state = piece[:2], 0, (0, 0, 0)
            waiting = piece
    if waiting is not None:
        yield stepped(waiting, waiting[2])


def _text(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    reader = spark.read.option("lineSep", "}").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    of = lambda c: F.col(f"_metadata.{c}")
    return reader.text(folder).select(
        of("file_path").alias("path"), of("file_block_start").alias("block"),
        (of("file_block_start") + of("file_block_length") >= of("file_size")).alias("final"), "value")


def block_starts(text: DataFrame) -> DataFrame:
    """path, block, quoted (1: it starts inside a string) and depth of the start of each block."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple, tuple] = {}
        for path, block, *_, quotes, outside, inside in _walk(batches):
            ends[path, block] = (quotes, outside, inside)
        rows = [(*k, *v) for k, v in ends.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "block", "quotes", "outside", "inside"), r)) for r in rows], pa.schema(
            [("path", pa.string()), ("block", pa.int64()), ("quotes", pa.int32()), ("outside", pa.int64()), ("inside", pa.int64())]))

    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = text.mapInArrow(summed, "path string, block long, quotes int, outside long, inside long")
    quoted = sums.withColumn("quoted", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    own = F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))
    return quoted.withColumn("own", own).select("path", "block", "quoted", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("depth"))


def _pieces(text: DataFrame, starts: DataFrame) -> DataFrame:
    """path, block, row, value, tail, and whether the piece starts or ends a record or is damage."""
    names = ("path", "block", "row", "value", "tail", "quotes", "outside", "inside", "quotes_after", "outside_after", "inside_after")
    schema = pa.schema([(n, {"path": pa.string(), "value": pa.string(), "tail": pa.bool_()}.get(n, pa.int64())) for n in names])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for piece in _walk(batches):
            rows.append(piece)
            if len(rows) == 2048:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    walk = text.mapInArrow(walked, "path string, block long, row long, value string, tail boolean, quotes long, outside long, "
                                   "inside long, quotes_after long, outside_after long, inside_after long")
    joined = walk.join(starts, ["path", "block"])
    at = lambda quotes: (F.col("quoted") + F.col(quotes)) % 2 == 1
    deep = lambda end: F.col("depth") + F.when(F.col("quoted") == 0, F.col(f"outside{end}")).otherwise(F.col(f"inside{end}"))
    known = joined.select(
        "path", "block", "row", "value", "tail", at("quotes").alias("in_string"), deep("").alias("deep"),
        at("quotes_after").alias("in_string_after"), deep("_after").alias("deep_after"))
    outside = ~F.col("in_string") & (F.col("deep") <= 1)
    first = outside & ~F.col("tail")
    sound = (
        F.when(F.col("tail") & (F.col("deep") == 0), outside & F.col("value").rlike(r"^\s*\[\s*\]\s*$"))
        .when(F.col("tail"), outside & F.col("value").rlike(r"^\s*\]\s*$"))
        .when(first & (F.col("deep") == 0), F.col("value").rlike(r"^\s*\[\s*\{"))
        .when(first, F.col("value").rlike(r"^\s*,\s*\{"))
        .otherwise(F.col("in_string") | (F.col("deep") > 1)))
    return known.select(
        "path", "block", "row", "value", "tail", first.alias("first"),
        (~F.col("tail") & ~F.col("in_string_after") & (F.col("deep_after") == 1)).alias("last"), (~sound).alias("bad"))


def _records(pieces: DataFrame) -> DataFrame:
    """path, pos and the text of every record."""
    begun = F.concat(F.regexp_replace("value", r"^[\s\[,]*", ""), F.lit("}"))
    single = pieces.where("first AND last").select("path", F.struct("block", "row").alias("pos"), begun.alias("record"))
    parts = pieces.where("NOT tail AND NOT (first AND last)").select(
        "path", "block", "row", F.when(F.col("first"), begun).otherwise(F.concat("value", F.lit("}"))).alias("value"),
        F.when(F.col("first"), F.struct("block", "row")).alias("start"))
    # The start of a piece's record is in its block, or the last one in the blocks before.
    so_far = Window.partitionBy("path", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("start", F.last("start", ignorenulls=True).over(so_far))
    blocks = parts.groupBy("path", "block").agg(F.max("start").alias("own")).withColumn("open", F.last("own", ignorenulls=True).over(
        Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).select("path", "block", "open")
    inside = parts.where("start IS NOT NULL")
    across = parts.where("start IS NULL").drop("start").join(blocks, ["path", "block"]).withColumnRenamed("open", "start")
    whole = inside.unionByName(across).groupBy("path", "start").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "row", "value"))), lambda x: x["value"]), "").alias("record"))
    return single.unionByName(whole.select("path", F.col("start").alias("pos"), "record"))


def _staged(records: DataFrame) -> str:
    """The records written one a line, with file and place as their first fields; the path.
    Only Spark's file reader keeps numbers and nested values as they are written."""
    place = F.to_json(F.struct(F.substring_index("path", "/", -1).alias(_FILE), F.col("path").alias(_PATH), F.col("pos.block").alias(_BLOCK), F.col("pos.row").alias(_ROW)))
    rest = F.substring(F.col("record"), F.lit(2), F.length("record"))
    comma = F.when(rest.rlike(r"^\s*\}$"), F.lit("")).otherwise(F.lit(","))
    path = shared_folder(records.sparkSession, "records")
    records.select(F.concat(F.substring(place, F.lit(1), F.length(place) - 1), comma, rest).alias("value")).write.option("lineSep", _LINE).text(path)
    return path


def read_split_arrays(spark: SparkSession, folder: str, glob: str, schema: StructType) -> DataFrame:
    """The rows of `read_json_batches` for files with arrays, each read by as many tasks as it
    has blocks. (`source_file`, `pos`) is the order in which sorted files hold their records."""
    text = _text(spark, folder, glob)
    starts = written(block_starts(text), "blocks")
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_BLOCKS else starts
    pieces = _pieces(text, starts)
    found = pieces.groupBy("path").agg(F.max("bad").alias("bad"), F.max("tail").alias("whole")).where("bad OR NOT whole")
    damaged = sorted(r.path for r in found.select("path").collect())  # names of damaged files only
    records = _records(pieces)
    path = _staged(records.where(~F.col("path").isin(damaged)) if damaged else records)
    full = StructType([*schema.fields, *(StructField(c, StringType()) for c in (_FILE, _PATH)), *(StructField(c, LongType()) for c in (_BLOCK, _ROW)),
                       StructField(DAMAGED, StringType())])
    rows = spark.read.schema(full).option("columnNameOfCorruptRecord", DAMAGED).option("lineSep", _LINE).json(path)
    # A record that can't be read still begins with the place that was put there.
    place = F.regexp_extract(DAMAGED, rf'"{_PATH}":("(?:[^"\\]|\\.)*")', 1)
    path = F.from_json(F.concat(F.lit('{"p":'), place, F.lit("}")), "p string")["p"]
    # The reader tells damage only beside a field.
    read = rows.where(F.col(DAMAGED).isNotNull()).select(path.alias("path"), _ROW).groupBy("path").agg(F.max(_ROW))
    unread = sorted(r.path for r in read.where("path IS NOT NULL").collect())
    if unread:
        rows = rows.where(~F.coalesce(F.col(_PATH), F.lit("")).isin(unread) & F.col(DAMAGED).isNull())
    out = rows.select(*schema.names, DAMAGED, F.col(_FILE).alias("source_file"), F.struct(F.col(_BLOCK).alias("block"), F.col(_ROW).alias("row")).alias("pos"))
    damaged += unread
    return out.unionByName(read_json_files(spark, damaged, schema)) if damaged else out
