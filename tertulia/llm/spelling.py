"""Spelling variants: words that differ by one letter, by a dictionary of trie-node pairs.

Every prefix of a word is a node of the forward trie, every suffix one of the reversed trie.
Both are numbered. A word with the letter at place i skipped is the pair of integers (node of
what stands before i, node of what stands after it); a word with a letter to be inserted at i
is the pair (node before i, node from i on). Two words differ by one replaced letter if they
share a pair with both skipped at it, by one inserted or deleted letter if a pair of the one
with a skip equals a pair of the other with an insertion: an equi-join on two integers finds
exactly these, and no distance is ever computed.

A pair of nodes fixes a word but for one letter, so that no key of the join holds more words
than the alphabet has letters, however many words there are. In a run of equal letters only
the last one is skipped against insertions, so that no link is found twice. Trie nodes are
told apart by the 128-bit fingerprint of their string, which keeps a word of n letters at 2n
short rows; every link is confirmed on the words themselves, so a clash could not invent one.

Words are counted before anything else moves, in each task first. Null and empty texts have
no words; rows that repeat a doc_id, or have none, each count (a null doc_id is hashed as an
empty string). Of words equally frequent the smallest in code-point order is taken. Words
of any length work, in time that grows with their length. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.llm.words import mix, spans, windows
from tertulia.sources.shared import written

#: Letters of a word: A to Z, a to z and the Latin letters from U+00C0 to U+00FF.
LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A near word is taken for the right form from so many times the word's own count on.
DOMINANCE = 5
#: Of runs whose checksum is a multiple of this, one letter is left out.
SLIP = 199

_SALTS = (0x1F123BB5, 0x5C0FFEE5)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(docs: DataFrame) -> DataFrame:
    """doc_id and run: every run of letters of every text, A-Z in lower case."""
    found = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"({LETTERS})"), 1)
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(found).alias("run")).select(
        "doc_id", _lower(F.col("run")).alias("run"))


def with_slips(found: DataFrame, slip: int = SLIP) -> DataFrame:
    """run: as found, but for the letter that the checksum of document and run leaves out."""
    h = F.crc32(F.encode(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), F.col("run")), "UTF-8"))
    at = (F.col("_sum") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.select("run", h.alias("_sum")).select(F.when(F.col("_sum") % slip == 0, cut).otherwise(F.col("run")).alias("run"))


def counted(found: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the runs that are long and frequent enough."""
    return found.where(F.length("run") >= least_letters).groupBy(F.col("run").alias("word")).agg(
        F.count("*").alias("n")).where(F.col("n") >= least_count)


def _slots(words: DataFrame) -> DataFrame:
    """word, n, place, skip, last and the fingerprints of what stands before and after: a row
    for each letter skipped and for each place to insert at. last: no equal letter follows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
            n = np.fromiter(map(len, texts), np.int64, len(texts))
            first = np.cumsum(n) - n
            for skip in (True, False):
                slots = n if skip else n + 1
                word, place = np.repeat(np.arange(len(n)), slots), spans(np.zeros(len(n), np.int64), slots)
                start, rest = first[word], n[word] - place - skip
                last = np.full(len(place), skip)
                if skip:
                    more = np.flatnonzero(rest)
                    last[more] = codes[(start + place)[more]] != codes[(start + place)[more] + 1]
                columns = [batch.column(c).take(pa.array(word)) for c in ("word", "n")]
                columns += [pa.array(place.astype(np.int32)), pa.array(np.full(len(place), skip)), pa.array(last)]
                for salt in _SALTS:
                    h = mix(codes, salt)
                    columns += [pa.array(windows(h, at, length).view(np.int64)) for at, length in ((start, place), (start + place + skip, rest))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n", "place", "skip", "last", "before_a", "after_a", "before_b", "after_b"])

    return words.mapInArrow(scan, "word string, n long, place int, skip boolean, last boolean, "
                                  "before_a long, after_a long, before_b long, after_b long")


def _dealt(df: DataFrame) -> DataFrame:
    """Joined by a shuffle. Spark would size what Arrow batches make of the words as the words
    themselves, and a written table as its compressed files, and gather millions of rows on the
    driver to broadcast them."""
    return df.hint("merge")


def numbered(slots: DataFrame, a: str, b: str, node: str) -> DataFrame:
    """The rows with the number of the trie node that the fingerprint (a, b) stands for."""
    nodes = written(slots.select(a, b).distinct().select("*", F.monotonically_increasing_id().alias(node)), node)
    return slots.join(_dealt(nodes), [a, b]).drop(a, b)


def pairs(words: DataFrame) -> DataFrame:
    """word, n, place, skip, last, before, after: the pairs of trie nodes of every place of
    every word, with the letter at it skipped or with one to be inserted before it."""
    slots = numbered(_slots(words), "before_a", "before_b", "before")
    return numbered(slots, "after_a", "after_b", "after").select("word", "n", "place", "skip", "last", "before", "after")


def _same_but_one(a: str, b: str, place: str, longer: bool) -> Column:
    """b is a without the letter at place (longer), or with another one there."""
    word, near, at = F.col(a), F.col(b), F.col(place)
    rest = F.substring(word, at + 2, F.length(word))
    return (F.substring(word, F.lit(1), at) == F.substring(near, F.lit(1), at)) & (
        rest == F.substring(near, at + (1 if longer else 2), F.length(near)))


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: all pairs of words that differ by one letter, both ways round."""
    every = written(pairs(words), "pairs")
    skips = every.where("skip").drop("skip")
    other = skips.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "before", "after")
    replaced = skips.join(_dealt(other), ["before", "after"]).where("word <> near").where(_same_but_one("word", "near", "place", False))
    inserts = every.where("NOT skip").select(F.col("word").alias("near"), F.col("n").alias("near_n"), "before", "after")
    deleted = skips.where("last").join(_dealt(inserts), ["before", "after"]).where(_same_but_one("word", "near", "place", True))
    deleted = deleted.select("word", "n", "near", "near_n")
    return replaced.select("word", "n", "near", "near_n").unionByName(deleted).unionByName(
        deleted.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def forms(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """word, n, n_near, form, form_n: the most frequent near word, where it is frequent enough."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(_dealt(found), "word", "left")
    form_n = -F.col("best.less")
    right = form_n >= dominance * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(right, F.col("best.near")).alias("form"), F.when(right, form_n).alias("form_n"))


def rooted(found: DataFrame) -> DataFrame:
    """The forms with root, the last one that following them leads to. A form is at least
    `dominance` times as frequent as its word, so paths are short and never return; each round
    doubles what has been followed."""
    steps = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("via"), F.col("root").alias("then"))
        further = steps.join(_dealt(ahead), F.col("root") == F.col("via"), "left")
        steps = written(further.select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "roots")
        if steps.where("moved").limit(1).count() == 0:
            break
        steps = steps.drop("moved")
    return found.join(_dealt(steps.select(F.col("word").alias("of"), "root")), F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """word, form, root, n, n_near, form_n of counted words (word, n)."""
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    return rooted(written(forms(words, dominance), "forms"))


def op13(docs: DataFrame) -> DataFrame:
    return variants(counted(with_slips(runs(docs))))


def oracle() -> str:
    """The same rows by SQL: the checksum bit by bit, near words by strings with a letter left out."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    data = "list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)"
    bits = f"flatten(list_transform(flatten({data}), lambda b: [b::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))"
    return f"""WITH RECURSIVE each AS (SELECT doc_id, run, count(*) AS c FROM (
      SELECT doc_id, translate(unnest(regexp_extract_all(text, '{LETTERS}')), '{upper}', '{lower}') AS run FROM documents) GROUP BY ALL),
    sums AS (SELECT run, c, xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM each),
    slips AS (SELECT CASE WHEN h % {SLIP} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM sums),
    words AS (SELECT word, sum(c)::BIGINT AS n FROM slips WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}),
    cuts AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)),
    shorter AS (SELECT DISTINCT c.word AS a, c.n AS an, w.word AS b, w.n AS bn FROM cuts c JOIN words w ON w.word = c.cut),
    links AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cuts x JOIN cuts y ON x.i = y.i AND x.cut = y.cut AND x.word <> y.word
      UNION ALL SELECT a, an, b, bn FROM shorter UNION ALL SELECT b, bn, a, an FROM shorter),
    best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM links),
    forms AS (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {DOMINANCE} * w.n THEN near END AS form,
      CASE WHEN near_n >= {DOMINANCE} * w.n THEN near_n END AS form_n FROM words w LEFT JOIN (SELECT * FROM best WHERE k = 1) b USING (word)),
    paths AS (SELECT word, word AS root, 0 AS steps FROM forms
      UNION ALL SELECT p.word, f.form, steps + 1 FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NOT NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, steps) AS root FROM paths GROUP BY word) USING (word)"""
