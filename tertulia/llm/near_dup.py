"""Near duplicates: MinHash signatures joined by a multi-index Hamming search.

A document's set holds its distinct shingles of five words (lower-cased A-Z). Its signature
holds `SYMBOLS` minima, 16 bits each; two sets of similarity s differ in each symbol with
probability 1 - s. The signature is cut into chunks of four symbols. By the pigeonhole
principle two signatures that differ in fewer than twice as many symbols as there are chunks
agree in some chunk but for one symbol at most; so each chunk is indexed four times, each
time with another symbol left open. Every pair within the signature distance meets in a
bucket; a pair of similarity 0.75 is missed with a probability of 1e-7.

Buckets are never expanded into pairs. Texts of equal sets are one class first. The members
of a bucket are compared, on their full sets, with its smallest set alone, which connects most
of them. Members around one such center that are still of several components are compared with
one another inside one task, up to `SMALL` of them. Larger groups that share members are one
family, so that none is compared once for each of its centers. A family is cut into blocks, and
each pair of blocks is one task's work, a product of 0-1 matrices; members of the largest
component are compared with those outside it alone. That decides every pair of a bucket.

Null and empty texts have the empty set and are linked with nothing; so are rows of a null
doc_id, whose component is null and which are kept. A text of fewer than five words is one
shingle. Rows that repeat a doc_id are expected to repeat its text; each gives a row. Ties go
to the smallest doc_id. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.llm.components import components
from tertulia.llm.words import SPACED, bounded_batches, mix, pieces, spans, split, windows
from tertulia.sources.shared import written

SHINGLE = 5
SYMBOLS = 48
CHUNK = 4
PERCENT = 75
#: Up to so many members and shingles are compared within one task.
SMALL = 3000
SMALL_SHINGLES = 1_000_000
#: Members and shingles whose intersections one product gives: some 25 MB at `SMALL` members.
ROWS_AT_ONCE = 512
COLUMNS_AT_ONCE = 1024

_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)
_TIMES = _rng.integers(0, 1 << 31, SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and where each text's start."""
    words = split(texts, SPACED, lower=True)
    counts = words.counts()
    n = np.where(counts < width, np.minimum(counts, 1), counts - width + 1)
    h = windows(words.hashes(), spans(words.docs[:-1], n), np.repeat(np.minimum(counts, width), n))
    at = np.concatenate([[0], np.cumsum(n)])
    for first, end in zip(at[:-1].tolist(), at[1:].tolist()):
        h[first:end].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[at[:-1][n > 0]] = True
    return h[new], np.concatenate([[0], np.cumsum(new)])[at]


def _signed(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes, two sums that name a set, and signatures."""
    n = np.diff(at)
    full = np.flatnonzero(n)
    sums = np.zeros((2, len(n)), np.uint64)
    symbols = np.zeros((len(n), SYMBOLS), np.uint16)
    if len(full):
        first = at[full]
        for k in range(2):
            sums[k, full] = np.add.reduceat(mix(h, 0xA5A5 + k), first)
        low = h.astype(np.uint32)
        for k in range(SYMBOLS):
            v = (low ^ _XOR[k]) * _TIMES[k]
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            symbols[full, k] = ((np.minimum.reduceat(v, first) * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)
    return n, sums[0].view(np.int64), sums[1].view(np.int64), symbols


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, size of the set, set_a and set_b (128 bits that name the set), signature."""
    bounded_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            n, a, b, symbols = _signed(*shingle_sets(texts))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b),
                 pa.array([s.tobytes() for s in symbols], pa.binary())],
                ["doc_id", "size", "set_a", "set_b", "signature"])

    return _texts(docs).mapInArrow(sign, "doc_id long, size long, set_a long, set_b long, signature binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def bucket_keys(classes: DataFrame) -> DataFrame:
    """rep, size and key: for each chunk, its number, the symbol left open, the other three."""
    chunks = SYMBOLS // CHUNK

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            s = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16)
            s = s.reshape(-1, chunks, CHUNK).astype(np.uint64)
            out = np.empty((len(s), chunks, CHUNK), np.uint64)
            for left_out in range(CHUNK):
                key = np.arange(chunks, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(left_out)
                for k in range(CHUNK):
                    if k != left_out:
                        key = (key << np.uint64(16)) | s[:, :, k]
                out[:, :, left_out] = key
            each = np.repeat(np.arange(len(s)), chunks * CHUNK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out.ravel().view(np.int64)), rows.column("rep").take(pa.array(each)), rows.column("size").take(pa.array(each))],
                ["key", "rep", "size"])

    return classes.select("rep", "size", "signature").mapInArrow(keys, "key long, rep long, size long")


def _shared(buckets: DataFrame) -> DataFrame:
    """Only buckets of two members or more."""
    keys = buckets.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    return buckets.join(keys, "key", "left_semi")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep and the bytes of its ascending shingle hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            h, at = shingle_sets(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                ["rep", "shingles"])

    texts = _texts(docs)
    return (
        texts.join(wanted, texts["doc_id"] == wanted["rep"], "left_semi")
        .mapInArrow(hashed, "rep long, shingles binary").dropDuplicates(["rep"])
    )


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """rep, center, whether they are linked and the size of rep's set, for every pair."""
    one = sets.select("rep", F.col("shingles").alias("mine"))
    other = sets.select(F.col("rep").alias("center"), F.col("shingles").alias("theirs"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
                     for a, b in zip(rows.column("mine").to_pylist(), rows.column("theirs").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("rep"), rows.column("center"), pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.int32())],
                ["rep", "center", "linked", "size"])

    return pairs.join(one, "rep").join(other, "center").select("rep", "center", "mine", "theirs").mapInArrow(
        compare, "rep long, center long, linked boolean, size int")


def _overlap(mine: np.ndarray, theirs: np.ndarray) -> int:
    if len(mine) > len(theirs):
        mine, theirs = theirs, mine
    if not len(theirs):
        return 0
    at = np.searchsorted(theirs, mine)
    at[at == len(theirs)] = 0
    return int((theirs[at] == mine).sum())


def linked(mine: np.ndarray, theirs: np.ndarray, percent: int = PERCENT) -> tuple[bool, int]:
    both = _overlap(mine, theirs)
    return 100 * both >= percent * (len(mine) + len(theirs) - both), len(mine)


def _unsettled(groups: DataFrame, label: DataFrame) -> DataFrame:
    """Members (rep) of centers around which not all are of one component yet."""
    named = groups.join(label.withColumnRenamed("id", "rep"), "rep", "left")
    part = F.coalesce("component", "rep")
    open_ = named.groupBy("center").agg(F.min(part).alias("low"), F.max(part).alias("high")).where("low < high").select("center")
    return groups.join(open_, "center", "left_semi")


def _alike(sets: list[np.ndarray], root: np.ndarray, split: int = 0) -> Iterator[tuple[int, int]]:
    """Pairs over the threshold of different roots, or with `split` those of one of the first so
    many sets and one of the others: all intersections of some rows at a time, as products of
    0-1 columns of the shingles that two sets or more hold. Roots may change meanwhile."""
    n = np.array([len(s) for s in sets])
    h = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
    twice = np.bincount(group) > 1
    if split:
        held_first = np.bincount(group[owner < split], minlength=len(twice))
        twice = (held_first > 0) & (held_first < np.bincount(group))
    column = (np.cumsum(twice) - 1)[group]
    keep = twice[group]
    owner, column = owner[keep], column[keep]
    for first in range(split, len(sets), ROWS_AT_ONCE):
        last = min(first + ROWS_AT_ONCE, len(sets))
        both = np.zeros((last - first, split or last), np.float32)
        for low in range(0, int(twice.sum()), COLUMNS_AT_ONCE):
            a, b = np.searchsorted(column, [low, low + COLUMNS_AT_ONCE])
            mine, place = owner[a:b], column[a:b] - low
            held = np.zeros((last, COLUMNS_AT_ONCE), np.float32)
            held[mine[mine < last], place[mine < last]] = 1
            both += held[first:] @ held[:split or last].T
        for i in range(max(first, 1), last):
            until = split or i
            row = both[i - first, :until].astype(np.int64)
            for j in np.flatnonzero((100 * row >= PERCENT * (n[i] + n[:until] - row)) & (root[:until] != root[i])):
                yield i, int(j)


def _within(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b), as many as connect them, inside groups (key, low, high) of members rep of a
    component part and a block: of block low with block high, or all where the two are one."""

    def connect(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        reps, root = group.column("rep").to_pylist(), group.column("part").to_numpy().copy()
        shingles = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        split = 0 if low == high else int((group.column("block").to_numpy() == low).sum())
        found = []
        for i, j in _alike(shingles, root, split) if low == high or 0 < split < len(reps) else ():
            if root[i] != root[j]:
                found.append((reps[i], reps[j]))
                root[root == root[j]] = root[i]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.join(sets, "rep").groupBy("key", "low", "high").applyInArrow(connect, "a long, b long")


def _blocks(n: str, shingles: str) -> Column:
    """Blocks for so many members and shingles, two of which are as much as one task compares."""
    return F.ceil(F.greatest(F.expr(f"2 * {n} / {SMALL}"), F.expr(f"2 * {shingles} / {SMALL_SHINGLES}")))


def _block_pairs(large: DataFrame, label: DataFrame) -> DataFrame:
    """The members of large groups for `_within`: a row for each pair of blocks that a member is
    compared in. Groups that share members, or whose center is a member, are one family."""
    family = components(large.select(F.col("rep").alias("a"), F.col("center").alias("b")), "families")
    members = (
        large.groupBy("rep").agg(F.max("size").alias("size"))
        .join(family.select(F.col("id").alias("rep"), F.col("component").alias("family")), "rep")
        .join(label.withColumnRenamed("id", "rep"), "rep", "left")
        .select("rep", "size", "family", F.coalesce("component", "rep").alias("part")))
    members = written(members, "members")
    parts = members.groupBy("family", "part").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    families = (
        parts.groupBy("family").agg(F.max(F.struct("n", "shingles", "part")).alias("most"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles"))
        .select("family", F.col("most.part").alias("most"), _blocks("most.n", "most.shingles").alias("first"),
                F.greatest(_blocks("(n - most.n)", "(shingles - most.shingles)"), F.lit(1)).alias("others")))
    inside, at = F.col("part") == F.col("most"), F.xxhash64("rep")
    block = F.when(inside, F.pmod(at, "first")).otherwise(F.col("first") + F.pmod(at, "others"))
    start = F.when(inside, F.col("first")).otherwise(F.lit(0).cast("bigint"))
    return (
        members.join(families, "family")
        .select(F.col("family").alias("key"), "rep", "part", block.alias("block"),
                F.explode(F.sequence(start, F.col("first") + F.col("others") - 1)).alias("with"))
        .select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "rep", "part"))


def _sized(groups: DataFrame) -> DataFrame:
    """The groups of two or more members, with whether one task can compare them all."""
    counts = groups.groupBy("center").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")).where("n > 1")
    return groups.join(counts.selectExpr("center", f"n <= {SMALL} AND shingles <= {SMALL_SHINGLES} AS small"), "center")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Of each document row doc_id, n_shingles, class_id (smallest doc_id of an equal set) and
    component_id (smallest doc_id reachable over links)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    signed = written(signatures(docs), "signatures")
    name = ["set_a", "set_b", "size"]
    classes = written(
        signed.where("size > 0 AND doc_id IS NOT NULL").groupBy(*name)
        .agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature")), "classes")
    buckets = written(_shared(bucket_keys(classes)), "buckets")
    sets = written(_sets(docs, buckets.select("rep").distinct()), "sets")
    centers = buckets.groupBy("key").agg(F.min(F.struct("size", "rep"))["rep"].alias("center"))
    pairs = buckets.join(centers, "key").where("rep <> center").select("rep", "center").distinct()
    compared = written(_compared(pairs, sets), "compared")
    links = compared.where("linked").select(F.col("rep").alias("a"), F.col("center").alias("b"))
    label = components(links)
    left = written(_unsettled(_sized(compared.select("rep", "center", "size")), label), "unsettled")
    one = F.lit(0).cast("bigint")
    small = (
        left.where("small").join(label.withColumnRenamed("id", "rep"), "rep", "left")
        .select(F.col("center").alias("key"), one.alias("low"), one.alias("high"), one.alias("block"), "rep", F.coalesce("component", "rep").alias("part")))
    new = written(_within(small, sets), "within")
    large = left.where("NOT small").select("rep", "center", "size")
    if not large.isEmpty():
        new = new.unionByName(written(_within(_block_pairs(large, label), sets), "between"))
    label = components(label.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(new))
    named = signed.join(classes.select(*name, "rep"), name, "left").select(
        "doc_id", "size", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("class_id"))
    return named.join(label, named["class_id"] == label["id"], "left").select(
        "doc_id", F.col("size").alias("n_shingles"), "class_id", F.coalesce("component", "class_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are the smallest of their component.

    Rows that repeat a kept doc_id are all kept; rows of a null doc_id too."""
    away = near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_away")).distinct()
    return docs.join(away, docs["doc_id"] == away["_away"], "left_anti")


def op3(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "class_id")
