"""Arrays read in blocks against the reader that takes a file whole."""

import json
import random

import pytest

from tertulia.sources.json_arrays import block_starts, read_split_arrays, _text
from tertulia.sources.json_batches import POSTS, damaged_records, read_json_batches


def records(seed, n):
    """Records with braces, quotes, escapes and brackets in their texts, and nested values."""
    r = random.Random(seed)
    odd = ["}", "{", '"', "\\", "]", "[", "},{", '\\"}', "é𝒳", "\n", "\t", "}}}", '"}]', "plain words ", ","]
    text = lambda: "".join(r.choice(odd) for _ in range(r.randint(0, 30)))
    out = []
    for k in range(n):
        one = {"title": text(), "text": text() * r.choice([1, 1, 9]), "author": None, "date": 1775572994.0 + k, "score": k, "url": f"https://{k}"}
        if k % 5 == 0:
            one["source"] = {"a": [1, {"b": text()}], "c": {}}
        out.append(one)
    return out


def rows(df):
    """What matters of the place is the order that it gives."""
    found = sorted(((r.source_file, r.pos.block, r.pos.row, tuple(r[c] for c in (*POSTS.names, "damaged"))) for r in df.collect()), key=lambda x: x[:3])
    return [(f, x) for f, _, _, x in found]


@pytest.fixture
def small_blocks(spark):
    key, open_cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key), spark.conf.get(open_cost)
    spark.conf.set(open_cost, "1")
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, before[0])
    spark.conf.set(open_cost, before[1])


@pytest.mark.parametrize("size", [150, 1000, 100_000])
@pytest.mark.parametrize("indent", [None, 4])
def test_blocks_give_the_same_rows(spark, tmp_path, small_blocks, size, indent):
    for k, n in enumerate((60, 1, 17)):
        (tmp_path / f"posts_{k}.json").write_text(json.dumps(records(k, n), indent=indent, ensure_ascii=bool(k)), encoding="utf-8")
    (tmp_path / "posts_7.json").write_text(" [ ]\n")
    want = rows(read_json_batches(spark, str(tmp_path), "posts_*.json", POSTS))
    small_blocks(size)
    got = rows(read_split_arrays(spark, str(tmp_path), "posts_*.json", POSTS))
    assert got == want and len(got) == 78


def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "posts_1.json").write_text(json.dumps(records(1, 400)), encoding="utf-8")
    small_blocks(4000)
    text = _text(spark, str(tmp_path), "posts_*.json")
    assert text.rdd.getNumPartitions() > 10
    starts = block_starts(text).orderBy("block").collect()
    assert len(starts) > 10 and starts[0].depth == 0 and {r.quoted for r in starts} == {0, 1}


@pytest.mark.parametrize("damage", [
    lambda t: t[: len(t) // 2], lambda t: t.rstrip()[:-1], lambda t: t.replace('"score"', '"score', 1), lambda t: t.replace("},", "} ", 1),
    lambda t: t + t, lambda t: "x" + t, lambda t: t.replace('"score": 3', '"score": tru'), lambda t: "{}", lambda t: '{"title": "alone"}', lambda t: "[1, 2]", lambda t: "null", lambda t: "[{}", lambda t: "  \n"])
def test_damage_is_the_same(spark, tmp_path, small_blocks, damage):
    good = json.dumps([{"title": f"t{k}", "score": k, "url": "u"} for k in range(9)], indent=2)
    (tmp_path / "posts_1.json").write_text(good)
    (tmp_path / "posts_2.json").write_text(damage(good))
    want = read_json_batches(spark, str(tmp_path), "posts_*.json", POSTS)
    expected, counts = rows(want), sorted(damaged_records(want).collect())
    small_blocks(50)
    got = read_split_arrays(spark, str(tmp_path), "posts_*.json", POSTS)
    assert rows(got) == expected and sorted(damaged_records(got).collect()) == counts


def test_no_files(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x")
    assert read_split_arrays(spark, str(tmp_path), "posts_*.json", POSTS).collect() == []


def test_without_broadcast(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr("tertulia.sources.json_arrays.BROADCAST_BLOCKS", 0)
    (tmp_path / "posts_1.json").write_text(json.dumps(records(3, 50)), encoding="utf-8")
    want = rows(read_json_batches(spark, str(tmp_path), "posts_*.json", POSTS))
    small_blocks(500)
    assert rows(read_split_arrays(spark, str(tmp_path), "posts_*.json", POSTS)) == want
