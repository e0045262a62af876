"""Passages that repeat across documents, by seeds and the runs of words around them.

Words are runs of anything but blank and the controls 0x09 to 0x0D, unchanged. Seeds come
from winnowing: of the runs of `SEED` words inside any `length` words, the one of the least
hash is the anchor of those words, so equal passages have equal anchors wherever they stand.
Documents meet on anchors. Matches are not extended word by word, which would take pairs:
around an anchor that two documents share, every run of `length` words that has this anchor is
hashed; runs that occur in a smaller doc_id too are repeats, and `without_repeats` joins
overlapping ones to maximal repeats. An anchor that millions of documents share costs one row a document, and the
runs meet by their hash (64 bits, not confirmed on words) through an aggregate to the smallest doc_id, never
in pairs. Whole copies are set aside first by a 128-bit name of their word sequence.

Null and empty texts have no words. A row is known by its doc_id and a hash of its text, so
rows that repeat a doc_id are each judged on their own text; they are no repeats of each other. Rows of a null doc_id are
returned unchanged and are no source of repeats. Of equal documents the smallest doc_id
keeps its words. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.llm.words import Words, bounded_batches, mix, pieces, spans, split, windows
from tertulia.sources.shared import written

LENGTH = 50
SEED = 12


def anchors(words: Words, h: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every run of `length` words inside one text its first word and its anchor's hash."""
    first, _ = words.starts_of(length)
    if not len(first):
        return first, np.zeros(0, np.uint64)
    grams = windows(h, np.arange(len(h) - seed + 1), seed)
    width, least, reach = length - seed + 1, grams, 1
    while reach * 2 <= width:  # minima over 2, 4, 8, ... runs, then two of those
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return first, np.minimum(least[first], least[first + width - reach])


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("text"))


def _seeds(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """doc_id and key of a row, the name of its word sequence, and its distinct anchors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            words = split(texts)
            h, n = words.hashes(), words.counts()
            names = [windows(x, words.docs[:-1], n) for x in (h, mix(h, 0x5EED))]
            _, least = anchors(words, h, length, seed)
            at = np.concatenate([[0], np.cumsum(np.maximum(n - length + 1, 0))])
            own = [np.unique(least[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            off = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("key"), pa.array(n, pa.int64()), *(pa.array(x.view(np.int64)) for x in names),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(own).view(np.int64)))],
                ["doc_id", "key", "n_words", "name_a", "name_b", "anchors"])

    return _texts(docs).where("doc_id IS NOT NULL").mapInArrow(
        scan, "doc_id long, key long, n_words long, name_a long, name_b long, anchors array<long>")


def _extensions(texts: DataFrame, shared: DataFrame, length: int, seed: int) -> DataFrame:
    """run (hash), doc_id, key and first word of every run of `length` words whose anchor is shared."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in pieces(batches):
            words = split(found)
            h = words.hashes()
            first, least = anchors(words, h, length, seed)
            doc = np.searchsorted(words.docs, first, "right") - 1
            # One lookup for all texts: an anchor is told apart by its text's number.
            lists = rows.column("shared")
            given = np.asarray(lists.flatten()).view(np.uint64)
            owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
            keys = np.sort(mix(given) + owner.astype(np.uint64))
            wanted = mix(least) + doc.astype(np.uint64)
            at = np.searchsorted(keys, wanted)
            at[at == len(keys)] = 0
            hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            first, doc = first[hit], doc[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows(h, first, length).view(np.int64)), rows.column("doc_id").take(pa.array(doc)),
                 rows.column("key").take(pa.array(doc)), pa.array((first - words.docs[doc]).astype(np.int32))], ["run", "doc_id", "key", "first"])

    return texts.join(shared, ["doc_id", "key"]).select("doc_id", "key", "text", "shared").mapInArrow(
        extend, "run long, doc_id long, key long, first int")


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, key, whole (all of it repeats a smaller doc_id), firsts: the first words of its runs
    of `length` words that occur in a smaller doc_id. Only documents that have any."""
    bounded_batches(docs.sparkSession)
    seeds = written(_seeds(docs, length, seed).where(f"n_words >= {length}"), "seeds")
    name = ["name_a", "name_b", "n_words"]
    smallest = seeds.groupBy(*name).agg(F.min("doc_id").alias("rep"))
    copies = seeds.select("doc_id", "key", *name).join(smallest, name).where("doc_id > rep").select("doc_id", "key").distinct()
    sources = written(
        seeds.join(smallest.select("rep").distinct(), F.col("doc_id") == F.col("rep"), "left_semi")
        .select("doc_id", "key", F.explode("anchors").alias("anchor")), "anchors")
    common = sources.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    shared = sources.join(common.select("anchor"), "anchor", "left_semi").groupBy("doc_id", "key").agg(
        F.collect_set("anchor").alias("shared"))
    runs = written(_extensions(_texts(docs), shared, length, seed), "runs")
    # Written, so that the join below has two plain shuffles and a hot run can be split.
    earliest = written(runs.groupBy("run").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                       .where("low < high").select("run", "low"), "earliest")
    found = runs.join(earliest, "run").where("doc_id > low").groupBy("doc_id", "key").agg(
        F.collect_set("first").alias("firsts"))
    return written(
        found.select("doc_id", "key", F.lit(False).alias("whole"), "firsts")
        .unionByName(copies.select("doc_id", "key", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("firsts"))), "repeats")


def _cut(docs: DataFrame, length: int, seed: int, schema: str, row) -> DataFrame:
    """row(words, mask of the removed ones) for every document."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "array<array<long>>": pa.list_(pa.list_(pa.int64()))}
    types = [types[c.split()[1]] for c in schema.split(", ")]
    found = repeats(docs, length, seed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            words = split(texts)
            out = []
            for k, (first, end) in enumerate(zip(words.docs[:-1], words.docs[1:])):
                n = int(end - first)
                gone = np.zeros(n, bool)
                if rows.column("whole")[k].as_py():
                    gone[:] = True
                elif (at := rows.column("firsts")[k].as_py()):
                    gone[spans(np.asarray(at), np.full(len(at), length))] = True
                out.append(row(words, int(first), n, gone))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out), types))], ["doc_id", *names])

    return _texts(docs).join(found, ["doc_id", "key"], "left").select(
        "doc_id", "text", "whole", "firsts").mapInArrow(cut, f"doc_id long, {schema}")


def _kept(words: Words, first: int, n: int, gone: np.ndarray) -> bytes:
    data = words.data
    return b" ".join(data[s:e].tobytes() for s, e, g in zip(
        words.starts[first: first + n].tolist(), words.ends[first: first + n].tolist(), gone.tolist()) if not g)


def _maximal(gone: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def without_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, text (kept words with a blank between), repeats (maximal repeats, first word and end)."""
    bounded_batches(docs.sparkSession)
    return _cut(docs, length, seed, "text string, repeats array<array<long>>",
                lambda w, first, n, gone: (_kept(w, first, n, gone).decode(), _maximal(gone)))


def op1(docs: DataFrame) -> DataFrame:
    return _cut(docs, LENGTH, SEED, "n_words long, n_removed long, kept_sha256 string",
                lambda w, first, n, gone: (n, int(gone.sum()), hashlib.sha256(_kept(w, first, n, gone)).hexdigest()))
