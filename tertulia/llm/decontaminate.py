"""Benchmark passages in documents, found by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z); words are runs of ASCII letters, digits and everything beyond
ASCII. A pattern is a run of `size` words of a benchmark item, or the whole item where it is
shorter. Patterns of one length m are searched together: a table gives for every block of
two words how far the search may jump, the last block of a pattern selects its bucket, and
the words themselves are compared before a match counts. Nothing is shuffled for it; only
(document, pattern) pairs of matches meet the items afterwards.

Patterns reach the executors in blocks of about `block` patterns. A block is searched for, to its
written matches, before the next is collected, and its tables are destroyed then, so that the driver
and each executor hold one block at a time and a benchmark of any size is searched whole. Every
document row has a key of its own, written with it where there are several blocks, by which what
they find meets; the result is the same for any number of blocks.

Null and empty texts have no words and match nothing. Rows that repeat a doc_id, and rows of
a null doc_id, are searched like any other; each gives a row, with its own hits and items.
Items without words are never found; items with equal windows are all reported, so that there
are no ties. A very long text is searched whole, as a piece of its own. Empty tables
give empty (or all-clean) results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tertulia.llm.rows import spare
from tertulia.llm.words import PLAIN, Words, bounded_batches, mix, pieces, split
from tertulia.sources.shared import written

#: The key of a document row, by which everything meets here in place of doc_id.
KEY = "_benchmark_row"

#: Words scanned by one lane; all lanes of a piece advance together.
LANE = 512
BLOCK = 100_000


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """item_id and each of its distinct windows, as lower-case words with a blank between."""
    bounded_batches(benchmark.sparkSession)

    def cut(batches):
        for rows, texts in pieces(batches):
            found = split(texts, PLAIN, lower=True)
            for item, first, end in zip(rows.column("item_id"), found.docs[:-1], found.docs[1:]):
                words = [found.data[s:e].tobytes() for s, e in zip(found.starts[first:end], found.ends[first:end])]
                runs = {b" ".join(words[k: k + size]) for k in range(max(1, len(words) - size + 1))} if words else ()
                if runs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item.as_py()] * len(runs), pa.int64()), pa.array([r.decode() for r in runs])],
                        ["item_id", "pattern"])

    return benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        cut, "item_id long, pattern string").distinct()


class Patterns:
    """Tables for the patterns of one length, given in words."""

    def __init__(self, texts: list[bytes]):
        words = split(texts, PLAIN)
        self.length = m = int(words.counts()[0])
        self.words = words.hashes().reshape(len(texts), m)
        self.block = min(2, m)
        bits = max(12, int(len(texts) * m * 4).bit_length())
        self.slots = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, min(m - self.block + 1, 255), np.uint8)
        for end in range(self.block, m + 1):
            slots = (self.blocks(self.words.ravel())[end - 1:: m] & self.slots).astype(np.int64)
            np.minimum.at(self.shift, slots, min(m - end, 255))
        suffix = self.blocks(self.words.ravel())[m - 1:: m]
        order = np.argsort(suffix, kind="stable")
        self.words, self.suffix = self.words[order], suffix[order]
        self.texts = [texts[k] for k in order]

    def blocks(self, h: np.ndarray) -> np.ndarray:
        """Hash of the block of words that ends at each position."""
        if self.block == 1:
            return h
        out = h.copy()
        out[1:] += h[:-1] * np.uint64(0xD6E8FEB86659FD93)
        return mix(out)

    def search(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of every run of words equal to a pattern."""
        m = self.length
        if len(h) < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        blocks = self.blocks(h)
        slots = (blocks & self.slots).astype(np.int64)
        at = np.arange(m - 1, len(h), LANE)
        stop = np.minimum(at + LANE, len(h))
        stopped = []
        while len(at):
            jump = self.shift[slots[at]]
            stopped.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        ends = np.concatenate(stopped)
        first, last = (np.searchsorted(self.suffix, blocks[ends], side) for side in ("left", "right"))
        found_at, found = [], []
        for k in range(int((last - first).max(initial=0))):
            inside = first + k < last
            e, p = ends[inside], first[inside] + k
            same = self.words[p, 0] == h[e - m + 1]
            e, p = e[same], p[same]
            same = (h[e[:, None] + np.arange(1 - m, 1)] == self.words[p]).all(axis=1)
            found_at.append(e[same] - m + 1)
            found.append(p[same])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


def _confirmed(words: Words, groups: list[Patterns]) -> Iterator[tuple[int, int, bytes]]:
    """First word, end and pattern of each match whose bytes are equal and in one text."""
    h = words.hashes()
    for group in groups:
        at, which = group.search(h)
        inside = np.searchsorted(words.docs, at, "right") == np.searchsorted(words.docs, at + group.length - 1, "right")
        for first, k in zip(at[inside].tolist(), which[inside].tolist()):
            end = first + group.length
            if b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[first:end], words.ends[first:end])) == group.texts[k]:
                yield first, end, group.texts[k]


def _tables(spark, patterns: list[str]):
    """The search tables of one block of patterns, on every executor."""
    lengths: dict[int, list[bytes]] = {}
    for p in patterns:
        lengths.setdefault(p.count(" ") + 1, []).append(p.encode())
    return spark.sparkContext.broadcast([Patterns(texts) for _, texts in sorted(lengths.items())])


def _matches(docs: DataFrame, tables, every: bool) -> DataFrame:
    """Of each document row (with a match, or `every`) the words inside a match, as first and
    end, and the patterns."""

    def search(batches):
        for rows, texts in pieces(batches):
            words = split(texts, PLAIN, lower=True)
            n = len(texts)
            spans: list[set] = [set() for _ in range(n)]
            names: list[set] = [set() for _ in range(n)]
            found = list(_confirmed(words, tables.value))
            for doc, (first, end, name) in zip(np.searchsorted(words.docs, [f for f, *_ in found], "right") - 1, found):
                spans[doc].add((first - int(words.docs[doc]), end - int(words.docs[doc])))
                names[doc].add(name.decode())
            out = pa.RecordBatch.from_arrays([
                rows.column(KEY), rows.column("doc_id"), pa.array(words.counts(), pa.int64()),
                pa.array([[{"first": a, "end": b} for a, b in _joined(s)] for s in spans],
                         pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                pa.array([sorted(s) for s in names], pa.list_(pa.string()))], [KEY, "doc_id", "n_words", "hits", "patterns"])
            yield out if every else out.filter(pa.array([bool(s) for s in spans]))

    return docs.select(KEY, "doc_id", "text").mapInArrow(
        search, f"{KEY} long, doc_id long, n_words long, hits array<struct<first: long, end: long>>, patterns array<string>")


def _blocks(patterns: DataFrame, block: int) -> Iterator[list[str]]:
    """The patterns in blocks of about so many, one at a time; one, perhaps empty, at least."""
    blocks = max(1, -(-patterns.count() // block))
    for k in range(blocks):
        part = patterns if blocks == 1 else patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k)
        yield [r[0] for r in part.collect()]


def _joined(spans: set) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, size: int = 10, block: int = BLOCK) -> DataFrame:
    """Of each document row doc_id, n_words, hits (spans of words, first and end), items
    (the item_ids found, sorted as strings)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias(KEY))
    windows = written(item_windows(benchmark, size), "windows")
    patterns = windows.select("pattern").distinct()
    several = patterns.count() > block
    if several:
        docs = written(docs, "rows")  # so that a row keeps its key from one search to the next
    # Each block is searched to its written matches before the next is collected. The first
    # search gives a row for every document, the others for documents with a match.
    parts = []
    for each in _blocks(patterns, block):
        tables = _tables(spark, each)
        parts.append(written(_matches(docs, tables, not parts), "matches"))
        tables.destroy()
    found = parts[0]
    if several:
        hit = reduce(DataFrame.unionByName, parts).where(F.size("hits") > 0).groupBy(F.col(KEY).alias("_key")).agg(
            F.flatten(F.collect_list("hits")).alias("_hits"), F.flatten(F.collect_list("patterns")).alias("_patterns"))
        found = found.join(hit, F.col(KEY) == F.col("_key"), "left").select(
            KEY, "doc_id", "n_words", F.when(F.col("_key").isNull(), F.col("hits")).otherwise(_joined_spans("_hits")).alias("hits"),
            F.coalesce("_patterns", "patterns").alias("patterns"))
    items = (
        found.where(F.size("patterns") > 0).select(F.col(KEY).alias("of"), F.explode("patterns").alias("pattern"))
        .join(windows, "pattern").groupBy("of").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    return found.join(items, found[KEY] == items["of"], "left").select(
        "doc_id", "n_words", "hits", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _joined_spans(column: str) -> F.Column:
    """Spans of several blocks, sorted and joined."""
    span = "struct<first: long, end: long>"
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(
        F.array_sort(column), F.array().cast(f"array<{span}>"),
        lambda a, x: F.when(
            (F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] >= x["first"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
                last(a)["first"].alias("first"), F.greatest(last(a)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(a, F.array(x))))


def without_hits(docs: DataFrame, benchmark: DataFrame, size: int = 10, block: int = BLOCK) -> DataFrame:
    """The documents, with all their columns, in which no benchmark window occurs. Rows go or
    stay in the task that reads them; with several blocks of patterns, what one leaves is
    written before the next is searched for, so that one table lives at a time."""
    spark = docs.sparkSession
    bounded_batches(spark)
    patterns = written(item_windows(benchmark, size).select("pattern").distinct(), "patterns")
    schema = docs.schema
    plain = schema["text"].dataType == StringType()  # else searched as a string beside itself
    body = "text" if plain else spare(docs.columns, "body")
    kept = docs

    def without(tables):
        def search(batches):
            for rows, texts in pieces(batches, body):
                words = split(texts, PLAIN, lower=True)
                firsts = [first for first, *_ in _confirmed(words, tables.value)]
                clean = np.ones(len(texts), bool)
                clean[np.searchsorted(words.docs, firsts, "right") - 1] = False
                yield rows.filter(pa.array(clean)).select(schema.names)

        rows = kept if plain else kept.withColumn(body, F.col("text").cast("string"))
        return rows.mapInArrow(search, schema)

    last = None
    for each in _blocks(patterns, block):
        if last is not None:
            kept = written(kept, "clean")
            last.destroy()
        last = _tables(spark, each)
        kept = without(last)
    return kept


def op7(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = benchmark_hits(docs, benchmark)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
