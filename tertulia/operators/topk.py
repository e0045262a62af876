"""The most frequent groups, exactly, without a shuffle of all groups.

Three steps over local counts. Every task counts the groups of its own rows and writes them
by falling count, unshuffled. (1) The `n` first of every task are summed; the n-th of these sums
is a bound that the n-th count can't fall under. (2) Counts of at least that bound's share of a
task are summed; a group that no task sends now can't reach the bound. What a group may have
beyond what was sent is less than a share for each task that didn't send it, so groups whose sum and
that together fall short of the n-th sum are out too. (3) What is left, some times n groups, is
counted in full. Rows that are shuffled: tasks times n, then tasks times the groups that are
left, while the vocabulary stays where it was read.

A task holds the counts of the groups in its own partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.sources.shared import written

#: Rows of local counts that are summed up again once so many have gathered.
FOLD_ROWS = 1 << 19
#: Texts that are cut into words at once.
TEXTS = 1_000


def _folded(parts: list[pa.Table], by: list[str]) -> pa.Table:
    return pa.concat_tables(parts).group_by(by).aggregate([("n", "sum")]).rename_columns([*by, "n"])


def gathered(tables: Iterable[pa.Table], by: list[str], rows: int) -> pa.Table | None:
    """The groups of all tables with their `n`. What was summed up once is summed up again only when
    as many rows have come since, so that the work grows with the rows, however many groups there are."""
    parts: list[pa.Table] = []
    waiting, limit = 0, rows
    for table in tables:
        found = table.group_by(by).aggregate([([], "count_all")])
        parts.append(found.rename_columns([*by, "n"]))
        waiting += len(found)
        if waiting > limit:
            parts = [_folded(parts, by)]
            waiting, limit = 0, max(rows, len(parts[0]))
    return _folded(parts, by) if any(map(len, parts)) else None


def _opened(texts: pa.Table, column: str, min_chars: int) -> pa.Table:
    """A row for each word of the texts, cut at spaces, that is long enough."""
    cut = pc.split_pattern(texts[column].combine_chunks(), " ")
    found, of = pc.list_flatten(cut), pc.list_parent_indices(cut)
    long = pc.greater_equal(pc.utf8_length(found), min_chars)
    found, of = found.filter(long), of.filter(long)
    return pa.table({c: found if c == column else texts[c].take(of) for c in texts.column_names})


def local_counts(rows: DataFrame, by: Sequence[str], words: str | None = None, min_chars: int = 0) -> DataFrame:
    """The groups of each task with their `n` there, its number as `task`, and `place` from 1
    by falling n. With `words` that column holds texts, whose words of `min_chars` are the groups."""
    by, fold = list(by), FOLD_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = (pa.Table.from_batches([b.slice(k, TEXTS)]) for b in batches for k in range(0, len(b), TEXTS)) if words else (
            pa.Table.from_batches([b]) for b in batches)
        own = gathered((_opened(t, words, min_chars) for t in tables) if words else tables, by, fold)
        if own is not None:
            own = own.sort_by([("n", "descending")])
            own = own.append_column("task", pa.array([TaskContext.get().partitionId()] * len(own), pa.int32()))
            own = own.append_column("place", pa.array(range(1, len(own) + 1), pa.int64()))
            yield from own.combine_chunks().to_batches(max_chunksize=10_000)

    kept = rows.select(*by)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(count, f"{fields}, n long, task int, place long")


def _nth(sums: DataFrame, n: int) -> int:
    """The n-th largest `low`; 0 where there are fewer."""
    top = sums.orderBy(F.desc("low")).select("low").limit(n).collect()  # n numbers
    return top[-1]["low"] if len(top) == n else 0


def candidates(local: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """The groups that may be among the n most frequent, ties with the last included."""
    tasks = local.where("place = 1").count()
    bound = _nth(local.where(F.col("place") <= n).groupBy(*by).agg(F.sum("n").alias("low")), n)
    share = bound / max(tasks, 1)
    sums = written(local.where(F.col("n") >= share).groupBy(*by).agg(F.sum("n").alias("low"), F.count(F.lit(1)).alias("sent")), "sums")
    return sums.where(F.col("low") + (tasks - F.col("sent")) * F.lit(share) >= _nth(sums, n)).select(*by)


def top_counts(rows: DataFrame, by: Sequence[str], n: int, name: str = "frequency", words: str | None = None, min_chars: int = 0) -> DataFrame:
    """The n most frequent groups of the `by` columns and how often each occurs; of equal counts
    the first in the order of `by`. Nulls are a value of their own. With `words`, a column of texts,
    its words of at least `min_chars` stand in its place; a text is sent to its task whole."""
    local = written(local_counts(rows, by, words, min_chars), "local")
    left = candidates(local, by, n)
    same = [local[c].eqNullSafe(left[c]) for c in by]
    return local.join(left, same, "left_semi").groupBy(*by).agg(F.sum("n").alias(name)).orderBy(F.desc(name), *by).limit(n)
