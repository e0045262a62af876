"""Large groups of near copies: right components, in rows that follow the number of texts."""

import random

import numpy as np

import corpus_pipeline
from tertulia.llm import near_dup
from tests.llm import brute


def near_copies(n=150, seed=9):
    """Copies of two texts with 1 to 30 words replaced, on both sides of the threshold."""
    r = random.Random(seed)
    base = [[f"{k}v{r.randrange(300)}" for _ in range(200)] for k in range(2)]
    docs = []
    for doc in range(n):
        words = list(base[doc % 3 == 0])
        for _ in range(r.randint(1, 4) if doc % 2 else r.randint(4, 16)):
            words[r.randrange(len(words))] = r.choice([f"e{r.randrange(10_000)}", r.choice(words)])
        docs.append((doc, " ".join(words)))
    return docs


def test_rows_of_large_groups_follow_the_texts(spark, monkeypatch):
    docs, rows = near_copies(), {}
    kept = near_dup.written

    def counted(df, name, **options):
        out = kept(df, name, **options)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(near_dup, "written", counted)
    monkeypatch.setattr(near_dup, "SMALL", 20)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.op3(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.op3(docs)
    assert len(docs) > 2 * sum(r[2] for r in got.values()) > 4  # some linked, some not
    # 48 buckets a text at most; shingles are never listed one a row.
    assert max(rows.values()) <= 48 * len(docs)


def test_pairs_of_two_blocks_are_those_across(monkeypatch):
    monkeypatch.setattr(near_dup, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(near_dup, "COLUMNS_AT_ONCE", 16)
    r = np.random.default_rng(3)
    sets = [np.unique(np.concatenate([np.arange(24), r.integers(24, 50, 14)])).astype(np.uint64) for _ in range(40)]
    alike = {(i, j) for i in range(40) for j in range(i) if near_dup.linked(sets[i], sets[j])[0]}
    root = np.arange(40)
    assert 0 < len(alike) < 780 and set(near_dup._alike(sets, root)) == alike
    assert set(near_dup._alike(sets, root, 13)) == {(i, j) for i, j in alike if j < 13 <= i}


def test_the_pipeline_stage_keeps_one_of_each_large_group(spark, monkeypatch):
    docs, rows = near_copies(60), []
    kept = near_dup.written

    def counted(df, name, **options):
        out = kept(df, name, **options)
        rows.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "written", counted)
    monkeypatch.setattr(near_dup, "SMALL", 10)
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    out = stage(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert {r.doc_id for r in out.collect()} == {doc for doc, (_, _, one) in brute.op3(docs).items() if one}
    assert max(rows) <= 48 * len(docs)
