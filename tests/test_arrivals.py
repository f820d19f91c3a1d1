"""Events that are stored once, buckets by user, and figures of spans of days."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import plan
from pyspark.sql import functions as F

from tests.test_daily import rows_of
from visitfold.lake import Lake
from visitfold.operators import arrivals, kpis
from visitfold.operators.sessions import build_sessions
from visitfold.plans import jobs
from visitfold.sources.bucketed import Buckets
from visitfold.sources.tables import read_table, table_days, write_table

SCHEMA = (
    "event_id STRING, user_id STRING, event_timestamp TIMESTAMP, event_type STRING, path STRING, "
    "referrer STRING, device STRING, country STRING, user_agent STRING, event_date DATE, corrupt_line STRING"
)


def some_events(seed, count=400):
    rng = random.Random(seed)
    start = datetime(2026, 8, 1)
    out = []
    for n in range(count):
        at = start + timedelta(minutes=rng.randint(0, 4 * 1440))
        path = rng.choice(["/a", "/b", None])
        out.append((str(n), f"u{rng.randint(0, 9)}", at, "click", path, None, None, "us", None, at.date(), None))
    return out


def keys(rows):
    return sorted({(row[1], row[2], row[3], row[4] or "") for row in rows})


def stored(spark, lake):
    rows = read_table(spark, lake.silver).select("user_id", "event_timestamp", "event_type", "path").collect()
    return sorted((row[0], row[1], row[2], row[3] or "") for row in rows)


@pytest.mark.parametrize("few", [arrivals.FEW, 0])
def test_nothing_is_stored_twice(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(arrivals.not_stored, "__defaults__", (arrivals.EVENT_KEY, few))
    lake, rows = Lake(str(tmp_path)), some_events(1)
    for load, part in [("one", rows[:250]), ("two", rows[100:300]), ("two", rows[100:300]), ("three", rows)]:
        jobs.append_silver_job(spark, lake, spark.createDataFrame(part, SCHEMA), load)
    assert stored(spark, lake) == keys(rows)
    added, days = jobs.append_silver_job(spark, lake, spark.createDataFrame(rows, SCHEMA), "four")
    assert (added, days) == (0, []) and stored(spark, lake) == keys(rows)


def test_days_that_were_rebuilt_are_known_again(spark, tmp_path):
    lake, rows = Lake(str(tmp_path)), some_events(2)
    jobs.append_silver_job(spark, lake, spark.createDataFrame(rows[:100], SCHEMA), "one")
    # a rebuild of two days from a bronze that has more
    write_table(spark.createDataFrame(rows[:300], SCHEMA), lake.bronze, ["event_date"])
    jobs.silver_job(spark, lake, since="2026-08-02", until="2026-08-03")
    assert set(table_days(spark, lake.silver_keys)) == {"2026-08-01", "2026-08-04"}
    jobs.append_silver_job(spark, lake, spark.createDataFrame(rows, SCHEMA), "two")
    assert stored(spark, lake) == keys(rows)


def test_stored_days_are_not_shuffled(spark, tmp_path):
    lake, rows = Lake(str(tmp_path)), some_events(3)
    jobs.append_silver_job(spark, lake, spark.createDataFrame(rows, SCHEMA), "one")
    new = jobs.silver_events(spark.createDataFrame(rows[:50], SCHEMA))
    write_table(arrivals.maybe_stored(new, read_table(spark, lake.silver_keys)), str(tmp_path / "told"))
    told = read_table(spark, str(tmp_path / "told"))
    assert told.where("maybe").count() == told.count() > 0
    text = plan(arrivals.not_stored(told, read_table(spark, lake.silver)))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    fresh = [(*row[:1], "new", *row[2:]) for row in rows]
    told = arrivals.maybe_stored(
        jobs.silver_events(spark.createDataFrame(fresh, SCHEMA)), read_table(spark, lake.silver_keys)
    )
    assert told.where("maybe").count() < 5


@pytest.mark.parametrize("share", [0, 100])
def test_large_loads_are_compared_by_one_join(spark, tmp_path, monkeypatch, share):
    """Nulls in keys, copies, other days; without bitmaps if the load is large next to its days."""
    lake, rows = Lake(str(tmp_path)), some_events(5)
    jobs.append_silver_job(spark, lake, spark.createDataFrame(rows[:250], SCHEMA), "one")
    monkeypatch.setattr(arrivals.is_large, "__defaults__", (0, share))
    told, asked = arrivals.maybe_stored, []
    monkeypatch.setattr(arrivals, "maybe_stored", lambda *given: asked.append(1) or told(*given))
    jobs.append_silver_job(spark, lake, spark.createDataFrame(rows[100:] + rows[300:], SCHEMA), "two")
    assert stored(spark, lake) == keys(rows) and bool(asked) == (share == 0)
    # what it added is known to the bitmaps
    monkeypatch.undo()
    assert jobs.append_silver_job(spark, lake, spark.createDataFrame(rows, SCHEMA), "three") == (0, [])


def test_many_repeats_take_one_join(spark, tmp_path):
    lake, rows = Lake(str(tmp_path)), some_events(6)
    jobs.append_silver_job(spark, lake, spark.createDataFrame(rows, SCHEMA), "one")
    new = jobs.silver_events(spark.createDataFrame(rows, SCHEMA))
    write_table(arrivals.maybe_stored(new, read_table(spark, lake.silver_keys)), str(tmp_path / "told"))
    text = plan(arrivals.not_stored(read_table(spark, str(tmp_path / "told")), read_table(spark, lake.silver), few=0))
    assert text.count("LeftAnti") == 1 and "LeftSemi" not in text


def test_no_arrivals(spark, tmp_path):
    lake = Lake(str(tmp_path))
    none = spark.createDataFrame([], SCHEMA)
    assert jobs.append_silver_job(spark, lake, none, "one") == (0, [])
    assert jobs.append_silver_job(spark, lake, none, "two") == (0, [])
    rows = some_events(4, 20)
    assert jobs.append_silver_job(spark, lake, spark.createDataFrame(rows, SCHEMA), "three")[0] == len(keys(rows))


# ---- buckets ------------------------------------------------------------------


def test_sessions_over_buckets_shuffle_no_events(spark, tmp_path):
    rows = [(f"u{n % 50}", datetime(2026, 8, 1) + timedelta(minutes=7 * n), "click", f"/{n}") for n in range(1000)]
    rows += [("hot", datetime(2026, 8, 1) + timedelta(seconds=n), "click", "/hot") for n in range(700)]
    events = spark.createDataFrame(rows, "user_id STRING, event_timestamp TIMESTAMP, event_type STRING, path STRING")
    buckets = Buckets("clicks_by_user", str(tmp_path / "buckets"), 4)
    buckets.write(events)
    usual, heavy = buckets.usual(spark), buckets.heavy(spark)
    assert {row[0] for row in heavy.select("user_id").distinct().collect()} == {"hot"}
    files = list((tmp_path / "buckets").glob("*.parquet"))
    assert 0 < len(files) <= 4
    text = plan(build_sessions(usual))
    assert "Exchange" not in text and "Bucketed: true" in text
    per_user = plan(kpis.sessions_per_user(build_sessions(usual)))
    assert "Exchange" not in per_user
    whole = build_sessions(events)
    both = build_sessions(usual).unionByName(build_sessions(heavy))
    assert rows_of(both, whole) == rows_of(whole, whole)
    spark.sql("DROP TABLE clicks_by_user")
    buckets.attach(spark, "user_id STRING, event_timestamp TIMESTAMP, event_type STRING, path STRING")
    assert "Exchange" not in plan(build_sessions(buckets.usual(spark))) and buckets.usual(spark).count() == 1000
    buckets.write(events.limit(0))
    assert buckets.usual(spark).count() == buckets.heavy(spark).count() == 0


# ---- spans of days --------------------------------------------------------------


def test_users_of_spans_are_within_the_error(spark, tmp_path):
    sessions = spark.range(60_000).select(
        F.concat(F.lit("u"), F.xxhash64("id") % 15_000).alias("user_id"),
        F.expr("date_add(DATE'2026-08-01', CAST(id % 30 AS INT))").alias("event_date"),
        (F.col("id") % 100).alias("duration_sec"),
        (F.col("id") % 3 == 0).alias("bounce"),
        (F.col("id") % 7 == 0).alias("converted"),
    )
    path = str(tmp_path / "days")
    write_table(kpis.daily_sketches(sessions), path, ["event_date"])
    assert read_table(spark, path).count() == 30
    for until in ("2026-08-01", "2026-08-07", "2026-08-30"):
        some = sessions.where(F.col("event_date") <= F.lit(until).cast("date"))
        exact = some.agg(F.countDistinct("user_id"), F.count(F.lit(1)), F.avg("duration_sec")).first()
        told = kpis.span_sessions(read_table(spark, path, until=until)).first()
        assert abs(told["distinct_users"] - exact[0]) <= kpis.USER_ERROR * exact[0]
        assert (told["num_sessions"], told["avg_duration_sec"]) == (exact[1], pytest.approx(exact[2]))
    assert kpis.span_sessions(read_table(spark, path, since="2027-01-01")).first()["distinct_users"] == 0
