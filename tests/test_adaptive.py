"""What adaptive execution does with hot slices, keys and days, at lowered limits."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from conftest import plan
from pyspark.sql import functions as F

from visitfold.operators.dimensions import look_up
from visitfold.operators.sessions import build_sessions, tag_sessions
from visitfold.operators.skew import salted_left_join
from visitfold.sources.tables import read_table, write_table


@contextmanager
def settings(spark, **values):
    values = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


SMALL_LIMITS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "40kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__shuffle__partitions": "8",
}


@pytest.fixture(scope="module")
def hot_events(spark, tmp_path_factory):
    """60,000 events; a third belong to one user and fall into one half hour."""
    path = str(tmp_path_factory.mktemp("events") / "hot")
    hot = F.col("id") % 3 == 0
    (
        spark.range(60_000)
        .select(
            F.col("id").alias("event_id"),
            F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("user_id"),
            F.timestamp_seconds(
                F.lit(1_785_542_400) + F.when(hot, F.col("id") % 1200).otherwise(F.col("id") * 7)
            ).alias("event_timestamp"),
            F.lit("click").alias("event_type"),
            F.concat(F.lit("/"), F.col("id")).alias("path"),
        )
        .repartition(12)
        .write.parquet(path)
    )
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def users(spark, hot_events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("users") / "users")
    hot_events.select("user_id").distinct().select(
        "user_id", F.upper("user_id").alias("name")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_a_hot_slice_is_split_when_events_are_tagged(spark, hot_events):
    with settings(spark, **SMALL_LIMITS):
        tagged = tag_sessions(hot_events)
        rows = tagged.collect()
        assert "ShuffledHashJoin(skew=true)" in plan(tagged)
    assert len(rows) == 60_000
    assert {r["session_index"] for r in rows if r["user_id"] == "hot"} == {1}


def test_a_hot_slice_is_one_row_per_task_when_sessions_are_built(spark, hot_events):
    with settings(spark, **SMALL_LIMITS):
        sessions = build_sessions(hot_events)
        assert sessions.where("user_id = 'hot'").first()["num_events"] == 20_000
        assert sessions.agg(F.sum("num_events")).first()[0] == 60_000


def test_a_hot_key_is_split_in_a_join_of_tables(spark, hot_events, users):
    with settings(spark, **SMALL_LIMITS):
        joined = look_up(hot_events, users.withColumnRenamed("user_id", "u"), "user_id", "u")
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(joined)


def test_salted_join_spreads_the_hot_key(spark, hot_events, users):
    with settings(spark, **SMALL_LIMITS):
        joined = salted_left_join(
            hot_events, users, "user_id", threshold=1000, factor=8, spread_by=["event_id"]
        )
        assert joined.where(F.col("name") == F.upper("user_id")).count() == 60_000
        assert "SortMergeJoin" in plan(joined)
    with settings(spark, **SMALL_LIMITS, spark__sql__adaptive__enabled="false"):
        joined = salted_left_join(
            hot_events, users, "user_id", threshold=1000, factor=8, spread_by=["event_id"]
        )
        tasks = joined.where("user_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 2 and max(r["count"] for r in tasks) < 20_000


def test_a_heavy_day_is_written_as_several_files(spark, hot_events, tmp_path):
    days = hot_events.withColumn(
        "event_date", F.when(F.col("user_id") == "hot", F.lit("2026-08-01")).otherwise("2026-08-02")
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="50kb"):
        assert write_table(days, str(tmp_path / "t"), ["event_date"], gather=True) == 60_000
    files = list((tmp_path / "t").glob("version=*/event_date=2026-08-01/*.parquet"))
    assert len(files) > 1
    assert read_table(spark, str(tmp_path / "t")).count() == 60_000
