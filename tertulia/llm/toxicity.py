"""Toxicity of texts: a weighted lexicon matched by Aho-Corasick, normalised by length.

Texts are folded first: lower case, homoglyphs (Cyrillic, Greek, full-width) to the Latin
letters they imitate, invisible characters away, digits and signs that stand for letters
(1d1ot, tr@sh) back to letters where they touch letters. Terms count as whole words; a match
inside an exception phrase doesn't count. Three figures of the matches (their summed weight,
the same for each root of the length, and whether there are any) go into a logistic score.

The lexicon is learned from labelled rows: the words whose documents are toxic beyond chance
(log-likelihood ratio), `TERMS` of them at most, each in `LEAST_DOCS` toxic documents at least;
`Model.left_out` counts the words that met the ratio and were beyond that number. Lexicon and score are fitted on a bounded
sample of labelled training rows, the `SAMPLE` smallest by a hash of doc_id; rows whose
crc32 of doc_id as text is a multiple of five are held out. Label, language, source and
doc_id are no inputs of a score. All texts are scored whole.

Null and empty texts score as texts without matches. Rows that repeat a doc_id are scored
one by one; in the training sample each counts. A null doc_id is not held out (its remainder
is null, held_out false) and never trains. Of labels that repeat a doc_id the larger value
counts; null labels train nothing. Without labels of both kinds there is no lexicon and every
score is the same, under one half. A very long text is folded and matched in one pass. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.llm.words import bounded_batches
from tertulia.sources.shared import written

#: Most labelled rows that train, most terms learned, least log-likelihood ratio of a term.
SAMPLE = 10_000
TERMS = 2_000
LEAST_RATIO = 20.0
LEAST_DOCS = 3

# Phrases in which a term is harmless.
EXCEPTIONS = ("class clown", "clown fish", "trash can", "trash bin", "trash bag", "take out the trash")

# Characters that imitate Latin letters.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјһԁѕкмтнв"
    "αεορτυχικν",
    "aeopcyxijhdskmthbaeoptuxikv")
HOMOGLYPHS |= {0xFF41 + k: chr(0x61 + k) for k in range(26)} | {0xFF10 + k: chr(0x30 + k) for k in range(10)}
HOMOGLYPHS |= dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
ODD = re.compile("[­Ͱ-ԯ​-‍⁠﻿＀-￯]")
LETTER_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
STANDS_FOR = re.compile(r"(?<=[^\W\d_])[013457@$!8](?=[^\W\d_@$!]|[013457@$!8][^\W\d_])|(?<![^\W_])[0134578](?=[^\W\d_])|(?<=[^\W\d_])[0134578](?![^\W_])")
WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii() and ODD.search(text):
        text = text.translate(HOMOGLYPHS).lower()
    return STANDS_FOR.sub(lambda m: LETTER_FOR[m[0]], text)


@dataclass
class Model:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Of the three figures and one, for a score without training.
    factors: list[float] = field(default_factory=lambda: [0.5, 0.5, 2.0, -3.0])
    left_out: int = 0
    _automaton: object = None

    def matches(self, folded: str) -> list[tuple[int, int, str]]:
        """Start, end and term of each lexicon word outside the exception phrases."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for term in {*self.weights, *self.exceptions}:
                self._automaton.add_word(term, term)
            self._automaton.make_automaton()
        found, harmless = [], []
        for last, term in self._automaton.iter(folded):
            first, end = last - len(term) + 1, last + 1
            if (first and folded[first - 1].isalnum()) or (end < len(folded) and folded[end].isalnum()):
                continue
            if term in self.weights:
                found.append((first, end, term))
            if term in self.exceptions:
                harmless.append((first, end))
        return [m for m in found if not any(a <= m[0] and m[1] <= b for a, b in harmless)] if harmless else found

    def figures(self, text: str) -> list[float]:
        folded = fold(text)
        weight = sum(self.weights[t] for _, _, t in self.matches(folded))
        return [math.log1p(weight), weight / math.sqrt(1 + folded.count(" ")), float(weight > 0), 1.0]

    def scores(self, figures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(figures @ np.asarray(self.factors), -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text and toxic of a bounded sample of the labelled rows that are not held out."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("of").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("of")))
        .groupBy("of").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("of"), "of").limit(sample))
    return docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "toxic")


def _word_counts(rows: DataFrame) -> DataFrame:
    """word, toxic and the documents that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found.update((w, toxic) for w in set(WORD.findall(fold(text))))
            words, toxic = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(toxic, pa.int32()), pa.array(list(found.values()), pa.int64())],
                ["word", "toxic", "n"])

    return rows.mapInArrow(count, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("good"))


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS, least_docs: int = LEAST_DOCS,
           least_ratio: float = LEAST_RATIO) -> Model:
    bounded_batches(docs.sparkSession)
    rows = written(training_rows(docs, labels, sample), "labelled")
    bad, good = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    if not bad or not good:
        return Model({})
    part = lambda seen, total: F.when(F.col(seen) > 0, F.col(seen) * F.log(
        F.col(seen) * float(bad + good) / ((F.col("bad") + F.col("good")) * float(total)))).otherwise(0.0)
    telling = written(
        _word_counts(rows).where(F.col("bad") >= least_docs)
        .withColumn("weight", F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0)))
        .withColumn("ratio", 2 * (part("bad", bad) + part("good", good)))
        .where((F.col("weight") > 1) & (F.col("ratio") >= least_ratio)), "telling")
    learned = telling.orderBy(F.desc("ratio"), "word").limit(terms).collect()
    model = Model({r["word"]: r["weight"] for r in learned}, left_out=telling.count() - len(learned))
    model.factors = _logistic(*_figures_of(rows, model))
    return model


def _figures_of(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([shared.value.figures(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64())),
                 batch.column("toxic")], ["figures", "toxic"])

    found = rows.mapInArrow(measure, "figures array<double>, toxic int").collect()  # the bounded sample's figures
    return np.array([r["figures"] for r in found]), np.array([float(r["toxic"] == 1) for r in found])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> list[float]:
    """Newton's method, the constant left out of the penalty."""
    b = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b.tolist()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            figures = np.array([shared.value.figures(t) for t in texts]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.scores(figures))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        score, "doc_id long, score double")


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fitted(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
