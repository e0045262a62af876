"""Each stage of the pipeline against a plain version, on its own input."""

from __future__ import annotations

import corpus_pipeline
from tertulia.llm import line_dedup, quality
from tertulia.sources.shared import written
from tests.llm import brute
from tests.llm.test_operators import _plain_mix

SF = "/root/testdata/sf0.001"


def test_stages_equal_their_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = written(stage(spark, docs, SF), "stage")
        after = {r.doc_id: r for r in out.collect()}
        texts = [(d, r.text) for d, r in before.items()]
        if name == "quality rules":
            assert set(after) == {r.doc_id for r in quality.op6(docs).collect() if r.kept}
        elif name == "line dedup":
            pages, counts = {}, {}
            for r in before.values():
                pages[r.source] = pages.get(r.source, 0) + 1
                for line in {x.strip(" \t\v\f\r") for x in r.text.split("\n")}:
                    counts[r.source, line] = counts.get((r.source, line), 0) + 1
            for d, r in before.items():
                kept = [x for x in r.text.split("\n") if not x.strip(" \t\v\f\r") or counts[r.source, x.strip(" \t\v\f\r")] < line_dedup.LEAST_PAGES
                        or counts[r.source, x.strip(" \t\v\f\r")] <= line_dedup.RATIO * pages[r.source]]
                assert after[d].text == "\n".join(kept)
        elif name == "near duplicates":
            assert set(after) == {d for d, (_, _, kept) in brute.op3(texts).items() if kept}
        elif name == "benchmark decontamination":
            assert set(after) == {d for d, x in brute.op7(texts, items).items() if not x[4]}
        else:
            taken = {}
            for r in out.collect():
                taken[r.doc_id] = taken.get(r.doc_id, 0) + r.mix_taken
            plan = _plain_mix([(d, r.text, r.source) for d, r in before.items()])
            assert taken == {d: x[3] for d, x in plan.items() if x[3]}
        docs = out
