"""Columns of our own beside those that a table happens to have."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.sources.shared import written


def spare(columns: Iterable[str], name: str) -> str:
    """The name, with underscores after it while the table has a column of that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """The rows with a number of their own, written once so that it keeps its value."""
    return written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
