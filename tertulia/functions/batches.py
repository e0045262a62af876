"""Arrow batches small enough for rows that hold long texts."""

from __future__ import annotations

#: Rows that Spark sends to Python at once; texts may be long.
BATCH_ROWS = 256


def bounded_batches(spark, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small enough for long texts, unless the session has them smaller."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
