"""Governance from the state that runs leave, against the figures from all rows."""

import pytest
from pyspark.sql import functions as F

from tertulia.operators.quality import governance_row
from tertulia.plans import governance_state

NAMED = ("id", "CASE WHEN id % 7 = 0 THEN '' WHEN id % 11 = 0 THEN NULL ELSE concat('t', id) END AS title",
         "CASE WHEN id % 3 = 0 THEN NULL ELSE 'a' END AS author")


def posts(spark, low, high, urls):
    return spark.range(low, high).selectExpr(
        *NAMED, "concat('x', id) AS text", f"CASE WHEN id % 50 = 1 THEN NULL ELSE concat('https://', id % {urls}) END AS url",
        "CASE WHEN id % 13 = 0 THEN NULL ELSE (id * 7919) % 10007 END AS score")


def exact(df):
    return governance_row(df, "posts", computed_at="now").first().asDict()


def by_state(spark, path):
    return governance_state.governance(spark, path, "now").first().asDict()


def test_small_runs_are_exact_but_for_the_median(spark, tmp_path):
    path, parts = str(tmp_path / "state"), [posts(spark, 0, 1500, 400), posts(spark, 1000, 4000, 900), posts(spark, 0, 0, 1)]
    whole = parts[0]
    for k, part in enumerate(parts):
        governance_state.add_run([governance_state.state_row(part, "posts")], path, f"run{k}")
        whole = whole if not k else whole.unionByName(part)
        want, got = exact(whole), by_state(spark, path)
        median = got.pop("score_median")
        want.pop("score_median")
        assert got == pytest.approx(want) and got["duplicate_rate"] == want["duplicate_rate"]
        ranks = whole.where("score IS NOT NULL").agg(F.count_if(F.col("score") < median), F.count_if(F.col("score") <= median), F.count("*")).first()
        assert ranks[0] / ranks[2] - 0.0133 * 3 <= 0.5 <= ranks[1] / ranks[2] + 0.0133 * 3


def test_many_urls_stay_within_the_bound(spark, tmp_path):
    path, whole = str(tmp_path / "state"), posts(spark, 0, 120_000, 60_000)
    for k in range(4):
        governance_state.add_run([governance_state.state_row(whole.where(F.col("id") % 4 == k), "posts")], path, f"run{k}")
    distinct = whole.select("url").distinct().count()
    estimate = 120_000 * (1 - by_state(spark, path)["duplicate_rate"] / 100)
    assert abs(estimate / distinct - 1) < 3 / 2 ** (governance_state.LG_URLS / 2)
    state = governance_state.runs.read_runs(spark, path, ["run0"])
    assert state.count() == 1 and all("/state/" in f for f in governance_state.governance(spark, path, "now").inputFiles())


def test_without_scores_or_runs(spark, tmp_path):
    path = str(tmp_path / "state")
    with pytest.raises(ValueError, match="no committed run"):
        governance_state.governance(spark, path, "now")
    df = posts(spark, 0, 50, 50)
    governance_state.add_run([governance_state.state_row(df, "posts", score=None)], path, "run0")
    want = governance_row(df, "posts", score=None, computed_at="now").first().asDict()
    assert by_state(spark, path) == pytest.approx(want)


def test_many_urls_and_scores_are_exact(spark, tmp_path):
    """More urls and scores than sketches kept, in runs that share urls."""
    path, parts = str(tmp_path / "state"), [posts(spark, 0, 50_000, 30_011), posts(spark, 20_000, 90_000, 41_017)]
    for k, part in enumerate(parts):
        governance_state.add_run([governance_state.state_row(part, "posts")], path, f"run{k}")
    want = exact(parts[0].unionByName(parts[1]))
    got = by_state(spark, path)
    assert got == pytest.approx(want)
    assert (got["duplicate_rate"], got["score_median"]) == (want["duplicate_rate"], want["score_median"])
    assert governance_state.governance(spark, path, "now", ["run1"]).first()["score_median"] == exact(parts[1])["score_median"]


def test_a_run_written_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "state")
    for low in (0, 300):
        governance_state.add_run([governance_state.state_row(posts(spark, low, 1000, 700), "posts")], path, "run0")
    assert by_state(spark, path) == pytest.approx(exact(posts(spark, 300, 1000, 700)))
