"""Heavy keys from a sketch of bounded size."""

from __future__ import annotations

import pytest
from conftest import plan
from pyspark.sql import functions as F

from visitfold.operators import heavy, skew


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """60,000 rows of 30,000 keys, far more than counters; a hot one, warm ones, and rows without a key."""
    path = str(tmp_path_factory.mktemp("events") / "events")
    n = F.col("id")
    key = (
        F.when(n % 3 == 0, "hot")
        .when(n % 20 == 1, F.concat(F.lit("warm"), n % 7))
        .when(n % 50 == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("cold"), F.floor(n / 2)))
    )
    spark.range(0, 60_000, 1, 9).select(n.alias("event_id"), key.alias("user_id")).write.parquet(path)
    return spark.read.parquet(path)


def pairs(rows):
    return {tuple(row) for row in rows.select("user_id", "event_count").collect()}


@pytest.mark.parametrize("parts", [10, 100, 1000])
def test_the_heavy_set_is_complete_and_exact(events, parts):
    total = events.count()
    counts = skew.naive_counts(events).where(F.col("user_id").isNotNull())
    expected = pairs(counts.where(F.col("event_count") * parts > total))
    assert "hot" in {key for key, _ in expected}
    assert pairs(heavy.heavy_counts(events, parts=parts)) == expected
    limited = heavy.heavy_counts(events, parts=parts, threshold=1000)
    assert pairs(limited) == {(key, n) for key, n in expected if n > 1000}


def test_proposals_are_few_and_shuffle_no_keys(events):
    proposed = heavy.proposed_keys(events, parts=10)
    assert proposed.count() <= 20
    # one sketch per task and group goes through a shuffle, and 64 of them to one task
    assert "hashpartitioning(user_id" not in plan(proposed)
    counts = plan(heavy.recounted(events, proposed))
    assert "BroadcastHashJoin" in counts and "SortMergeJoin" not in counts


def test_salting_counts_no_key_first(events):
    counted = skew.hot_salted_counts(events, threshold=1000, factor=4, spread_by=["event_id"], parts=10)
    assert pairs(counted) == pairs(skew.naive_counts(events))
    text = plan(counted)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    # the only shuffle by user alone is of partial counts by salt
    assert text.count("hashpartitioning(user_id") == 2 and "hashpartitioning(user_id#" in text
    assert text.index("sum(partial_count") < text.index("hashpartitioning(user_id")


@pytest.mark.parametrize("top_n", [1, 5, 8, 30])
def test_top_keys(events, top_n):
    found = [tuple(row) for row in heavy.top_keys(events, top_n).collect()]
    assert found == [tuple(row) for row in skew.key_skew_report(events, top_n).collect()]


def test_top_keys_without_a_count_of_all(events):
    # eight keys stand out, so the proposals hold the answer
    assert "proposed" not in plan(heavy.top_keys(events, 5))
    assert "approx_top_k" not in plan(heavy.top_keys(events, 5))
    assert "event_id" not in plan(heavy.top_keys(events, 5))
    read = heavy.top_keys(events, 5).inputFiles()
    assert all("/top-" in file for file in read)
    # where all are alike, they are counted
    assert not any("/top-" in file for file in heavy.top_keys(events, 3000).inputFiles())


def test_no_events(events):
    empty = events.limit(0)
    assert heavy.heavy_counts(empty).collect() == []
    assert heavy.top_keys(empty).collect() == []
    assert skew.hot_salted_counts(empty, spread_by=["event_id"]).collect() == []


def test_numbers_as_keys(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("user_id"), F.col("id").alias("event_id"))
    assert pairs(heavy.heavy_counts(rows, parts=20)) == {(key, 100) for key in range(10)}
