"""Rows that share a doc_id or have none, columns of any name, and one table of patterns at a time."""

from __future__ import annotations

import pytest

from tertulia.llm import decontaminate, licenses, line_dedup, mixing, substring
from tests.llm import brute

NAMES = ["_of", "_drop", "mix_taken", "mix_copy", "_benchmark_row", "of", "at", "drop", "row", "copy", "body", "key"]


def named(spark, rows):
    """Rows (doc_id, text, source) beside columns of the names that the operators would take."""
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in NAMES)
    return spark.createDataFrame([(*r, len(r[1] or ""), *(f"{c}!" for c in NAMES)) for r in rows], schema)


def kept_names(out):
    assert all(r[c] == f"{c}!" for r in out.collect() for c in NAMES)


def test_two_texts_of_one_doc_id_repeat_on_their_own(spark):
    shared, own = " ".join(f"p{k}" for k in range(60)), " ".join(f"q{k}" for k in range(61))
    rows = [(1, shared), (2, shared + " tail"), (2, own), (None, shared), (3, own)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.op1(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("1", 60, 0, brute.sha(shared)), ("2", 61, 60, brute.sha("tail")), ("2", 61, 0, brute.sha(own)),
                          ("None", 60, 0, brute.sha(shared)), ("3", 61, 61, brute.sha(""))])


def test_labels_stay_with_their_row(spark):
    mpl = "this source code form is subject to the terms of the mozilla public license v 2 0"
    rows = [(None, "nothing here at all"), (None, mpl), (1, mpl), (1, "plain"), (None, None)]
    got = sorted((str(r.doc_id), r.labels, r.score) for r in licenses.op8(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("1", "", 0.0), ("1", "mpl-2.0", 1.0), ("None", "", 0.0), ("None", "", 0.0), ("None", "mpl-2.0", 1.0)]


def test_lines_of_one_doc_id_on_two_hosts(spark):
    rows = [(k, f"menu\nown {k}", "a") for k in range(50)] + [(7, "menu\nelsewhere", "b"), (None, "menu\nno id", "a")]
    out = line_dedup.without_boilerplate(named(spark, rows))
    assert out.columns == named(spark, rows).columns
    kept_names(out)
    texts = {(r.doc_id, r.source): (r.text, r.n_chars) for r in out.collect()}
    assert texts[7, "a"] == ("own 7", 5) and texts[7, "b"][0] == "menu\nelsewhere" and texts[None, "a"][0] == "menu\nno id"


def test_the_mix_takes_rows_not_doc_ids(spark):
    text = "w " * 20
    rows = [(2, text, "a"), (2, text + "x", "a"), (None, "w " * 10, "a"), (None, "v " * 10, "a"), (3, "u " * 500, "b")]
    df = named(spark, rows)
    planned = sum(r.taken for r in mixing.op9(df.select("doc_id", "text", "source")).collect() if r.doc_id != 3)
    out = mixing.mixed(df)
    assert out.columns == [*df.columns, "mix_position", "mix_copy_", "mix_taken_"]
    kept_names(out)
    mixed = out.collect()
    assert sum(r.mix_taken_ for r in mixed if r.source == "a") == planned
    for r in mixed:
        assert 0 < r.mix_taken_ <= len(brute.words(r.text))
    # Each row of source a gives all its words in every copy but the last one taken.
    whole = [r for r in mixed if r.source == "a" and r.mix_taken_ == len(brute.words(r.text))]
    assert {(r.doc_id, r.text) for r in whole if r.mix_copy_ == 0} >= {(2, text), (None, "v " * 10)} or len(whole) >= 3
    places = [r.mix_position for r in mixed]
    assert places == sorted(places)


@pytest.mark.parametrize("block", [30, 100_000])
def test_one_table_of_patterns_lives_at_a_time(spark, block, monkeypatch):
    alive, most, made = [], [], decontaminate._tables

    class Counted:
        def __init__(self, tables):
            self.tables = tables
            alive.append(self)
            most.append(len(alive))

        def destroy(self):
            alive.remove(self)
            self.tables.destroy()

    def counted(spark, patterns):
        assert len(patterns) < 100
        return Counted(made(spark, patterns))

    monkeypatch.setattr(decontaminate, "_tables", counted)
    searched, without = decontaminate._matches, decontaminate.without_hits
    monkeypatch.setattr(decontaminate, "_matches", lambda docs, tables, every: searched(docs, tables.tables, every))
    items = [(k, " ".join(f"i{k}x{j}" for j in range(30))) for k in range(4)]
    rows = [(k % 3, items[k % 4][1] if k % 2 else f"own {k}", "a") for k in range(12)] + [(None, None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.benchmark_hits(named(spark, rows), bench, block=block).collect()
    assert len(hits) == 13 and sum(bool(r.hits) for r in hits) == 6
    assert max(most) == 1 and not alive and len(most) == (1 if block > 1000 else 3)
    monkeypatch.undo()
    clean = without(named(spark, rows), bench, block=block)
    assert clean.columns == named(spark, rows).columns and clean.count() == 7
    kept_names(clean)


def test_with_one_block_the_stage_shuffles_nothing(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    out = decontaminate.without_hits(named(spark, [(1, "x alpha beta gamma y", "a"), (2, "x", "b")]), bench)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString() and [r.doc_id for r in out.collect()] == [2]


@pytest.mark.parametrize("op", [line_dedup.op4, mixing.op9, licenses.op8])
def test_a_very_long_text(spark, op):
    long = "\n".join(f"line {k} of mit license words" for k in range(60_000))
    out = op(spark.createDataFrame([(1, long, "a"), (2, "short", "a")], "doc_id long, text string, source string")).collect()
    row = {r.doc_id: r for r in out}[1]
    assert {"n_lines": 60_000, "size": 360_000, "n_base": 60_000}.items() & row.asDict().items()
