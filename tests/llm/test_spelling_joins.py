"""Tables that grow with the words are joined by shuffles, whatever size Spark takes them for."""

from tertulia.llm import spelling


def test_nothing_of_the_words_is_broadcast(spark, monkeypatch):
    docs = [(k, " ".join(w[:j] + w[j + 1:] if k == 0 else w for w in ("harvest", "letters", "journey") for j in range(7))) for k in range(9)]
    plans, kept = [], spelling.written

    def seen(df, name, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name, **options)

    monkeypatch.setattr(spelling, "written", seen)
    monkeypatch.setattr(spelling, "LEAST_COUNT", 1)
    words = spelling.counted(spelling.with_slips(spelling.runs(spark.createDataFrame(docs, "doc_id long, text string"))), least_count=1)
    out = spelling.variants(words)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    rows = {r.word: (r.form, r.root) for r in out.collect()}
    assert rows["harves"] == ("harvest", "harvest") and rows["harvest"] == (None, "harvest")
    assert sum("Join" in p for p in plans) > 3 and not [p for p in plans if "Broadcast" in p]
