"""Ordered deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], copies: str | None = None
) -> DataFrame:
    """The first row per key in `order`; null keys form one group.

    An aggregate, not a window: each map task sends at most one row per key, so a key
    holding a third of the table costs no more than any other. `order` must be total
    within a key for the pick to be unique. `copies` names a column for the rows per key.
    """
    rest = [c for c in df.columns if c not in keys]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not rest:
        return df.groupBy(*keys).agg(*counted) if counted else df.distinct()
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first, *counted).select(
        *[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns],
        *([copies] if copies else []),
    )


def keep_first_late(table: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`keep_first` of a Parquet table whose rows are wide. Null keys form one group.

    The winners are picked from the keys' digests, the order and the address of each row (its
    file and its number there), so that no body is in the first shuffle. Whole rows are then read
    for the winners alone, by a semi-join on the address: where the winners are few Spark broadcasts
    them, and on a large table it puts a Bloom filter of their addresses before the rows that are
    shuffled. Pays where many rows are copies; else `keep_first` moves less.
    """
    digest = F.concat_ws("-", *(F.coalesce(F.md5(F.col(c).cast("string")), F.lit("none")) for c in keys))
    address = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    narrow = table.select(digest.alias("_key"), F.struct(*order).alias("_order"), address.alias("_address"))
    ours = "_late"
    while any(c.lower().startswith(ours) for c in table.columns):
        ours += "_"
    winners = narrow.groupBy("_key").agg(F.min_by("_address", "_order").alias("_first")).select(
        F.col("_first.file").alias(f"{ours}_of"), F.col("_first.row").alias(f"{ours}_at"))
    placed = table.select(*table.columns, F.col("_metadata.file_path").alias(f"{ours}_file"), F.col("_metadata.row_index").alias(f"{ours}_row"))
    same = (F.col(f"{ours}_file") == F.col(f"{ours}_of")) & (F.col(f"{ours}_row") == F.col(f"{ours}_at"))
    return placed.join(winners, same, "left_semi").select(*table.columns)
