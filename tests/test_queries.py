import os
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    from check import connect

    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["day", "source", "avg_polarity", "record_count", "polarity_ma_7d"] and df.count() > 0


def test_other_queries_are_there_without_the_optional_imports(monkeypatch):
    import __spark_entry__

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("tertulia.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    assert __spark_entry__._optional() == ({}, {}) and len(__spark_entry__.QUERIES) > 100


@pytest.mark.parametrize("key", list(queries()))
def test_query_equals_its_sql(spark, con, key):
    from check import compare

    same, note = compare(spark, con, SF, key)
    assert "types" not in note, note
    assert same is (True if key in oracle_sql() else None), note
