"""Numbered live sessions, kept late rows and open sessions."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F

from tests.test_daily import rows_of
from tests.test_streaming import LATER, click, land, line
from visitfold.lake import Lake, Settings
from visitfold.operators.cleaning import identified
from visitfold.operators.sessions import build_sessions, session_rows
from visitfold.plans import jobs
from visitfold.sources import manifests
from visitfold.sources.landing import read_landing, type_events
from visitfold.sources.tables import read_table, table_days
from visitfold.streaming import late, live, numbered

NAME = "live_sessions_raw"


def stream(spark, lake, **more):
    return jobs.stream_job(spark, lake, **({"sink": "table", "clean": False, "timeout": 120} | more))


def told(spark, lake, name=NAME):
    return read_table(spark, lake.stream_table(f"{name}_numbered"))


def whole(spark, lake):
    return build_sessions(identified(type_events(read_landing(spark, lake.landing))), exact=True)


def visits_of(rng, users, hours):
    """Clicks of users in order of time, and one far later event that closes all windows."""
    out = []
    for user in users:
        now = datetime(2026, 8, 1)
        while now < datetime(2026, 8, 1) + timedelta(hours=hours):
            out.append((now, user, rng.choice(["/a", "/b", "/c"])))
            now += timedelta(seconds=rng.choice([0, 60, 1800, 1801, 1800.5, 5000]))
    return sorted(out)


def as_lines(visits):
    return [
        line(event_id=str(n), user_id=user, event_timestamp=now.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), path=path)
        for n, (now, user, path) in enumerate(visits)
    ]


def test_numbers_and_ids_are_those_of_the_batch(spark, tmp_path):
    lake, rng = Lake(str(tmp_path)), random.Random(1)
    visits = visits_of(rng, ["u1", "u2", "u3"], 40)
    for k in range(4):
        part = visits[k * len(visits) // 4 : (k + 1) * len(visits) // 4]
        land(lake, f"part{k}", *as_lines(part), order=k)
        if k % 2:
            stream(spark, lake, files_per_batch=1)
    land(lake, "end", line(user_id="last", event_timestamp="2026-08-05T00:00:00.000Z"), order=9)
    stream(spark, lake)
    expected = whole(spark, lake).where("user_id <> 'last'")
    assert rows_of(told(spark, lake), expected) == rows_of(expected, expected)
    assert table_days(spark, lake.stream_table(f"{NAME}_numbered")) == ["2026-08-01", "2026-08-02"]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    sessions, counts = str(tmp_path / "s"), str(tmp_path / "c")
    run = numbered.number_batch(sessions, counts)

    def batch(*rows):
        made = spark.createDataFrame(
            [((at(a), "/x"), (at(b), "/y"), 2, 1, 0, user) for user, a, b in rows],
            "entry STRUCT<event_timestamp: TIMESTAMP, path: STRING>, exit STRUCT<event_timestamp: TIMESTAMP, "
            "path: STRING>, num_events LONG, num_pageviews LONG, purchases LONG, user_id STRING",
        )
        return made.withColumn("window_end", F.col("exit.event_timestamp"))

    def index():
        found = read_table(spark, sessions).collect()
        return sorted((row["user_id"], row["start_ts"].hour, row["session_id"]) for row in found)

    first = batch(("a", "10:00", "10:10"), ("a", "12:00", "12:10"), ("b", "10:00", "10:10"))
    second = batch(("a", "14:00", "14:10"), ("c", "14:00", "14:10"))
    run(first, 0)
    run(second, 1)
    once = index()
    run(first, 0)
    run(second, 1)
    assert index() == once and len({key for *_, key in once}) == 5

    # counts are there and the sessions are not: the batch was cut short
    before = manifests.latest(spark, sessions)
    third = batch(("a", "16:00", "16:10"), ("a", "18:00", "18:10"))
    run(third, 2)
    done = index()
    manifests.commit(
        spark, sessions, manifests.renumbered(manifests.latest(spark, sessions), places=before.places, loads=before.loads)
    )
    run(third, 2)
    assert index() == done


def test_a_batch_is_computed_once(spark, tmp_path):
    """Its plan reads files and state again each time it runs."""
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(user):
        runs.add(1)
        return user

    rows = [((at(f"{10 + n}:00"), "/x"), (at(f"{10 + n}:10"), "/y"), 2, 1, 0, "u") for n in range(5)]
    batch = spark.createDataFrame(
        rows,
        "entry STRUCT<event_timestamp: TIMESTAMP, path: STRING>, exit STRUCT<event_timestamp: TIMESTAMP, "
        "path: STRING>, num_events LONG, num_pageviews LONG, purchases LONG, user_id STRING",
    ).withColumn("user_id", seen("user_id"))
    for number in range(2):
        numbered.number_batch(str(tmp_path / "s"), str(tmp_path / "c"))(batch, number)
    assert runs.value == 10
    ids = {row["session_id"] for row in read_table(spark, str(tmp_path / "s")).collect()}
    assert len(ids) == 10 and read_table(spark, str(tmp_path / "c")).agg(F.max("sessions")).first()[0] == 10


def test_a_day_of_a_batch_has_few_files(spark, tmp_path):
    """A stream's session has no adaptive execution; each of its tasks would write every day."""
    lake = Lake(str(tmp_path))
    rows = [(datetime(2026, 8, day, hour), f"u{user}", "/a") for day in (1, 2) for hour in (3, 9) for user in range(40)]
    land(lake, "all", *as_lines(sorted(rows)), order=0)
    land(lake, "end", line(user_id="last", event_timestamp="2026-08-05T00:00:00.000Z"), order=1)
    stream(spark, lake)
    expected = whole(spark, lake).where("user_id <> 'last'")
    assert rows_of(told(spark, lake), expected) == rows_of(expected, expected)
    for day in (1, 2):
        files = (tmp_path / "stream").rglob(f"{NAME}_numbered/version=*/event_date=2026-08-0{day}/*.parquet")
        assert len(list(files)) == 1


def test_counts_are_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbered, "GATHERED", 2)
    lake = Lake(str(tmp_path))
    for k in range(5):
        land(lake, f"f{k}", click("u1", f"{10 + 2 * k}:00:00.000"), order=k)
    land(lake, "end", line(user_id="last", event_timestamp="2026-08-05T00:00:00.000Z"), order=9)
    stream(spark, lake, files_per_batch=1)
    ids = {row["session_id"] for row in told(spark, lake).where("user_id = 'u1'").collect()}
    assert ids == {row["session_id"] for row in whole(spark, lake).where("user_id = 'u1'").collect()}
    counts = lake.stream_table(f"{NAME}_numbered_counts")
    assert len(manifests.latest(spark, counts).versions) <= 4


def test_open_and_closed_sessions_are_all(spark, tmp_path):
    lake, visits = Lake(str(tmp_path)), visits_of(random.Random(2), ["u1", "u2"], 20)
    land(lake, "a", *as_lines(visits))
    query = stream(spark, lake)
    held = live.open_sessions(spark, lake.checkpoint(query.name, "table"))
    closed, everything = told(spark, lake), whole(spark, lake)
    names = [name for name in everything.columns if name != "session_id"]
    still = session_rows(held.withColumn("session_id", F.lit(None).cast("string"))).select(*names)
    assert 0 < still.count() < everything.count()
    both = closed.select(*names).unionByName(still)
    assert rows_of(both, everything.select(*names)) == rows_of(everything.select(*names), everything.select(*names))
    assert dict(held.dtypes)["window_end"] == "timestamp"


def late_table(spark, lake):
    return sorted(row["event_id"] for row in read_table(spark, lake.stream_table(f"{NAME}_late")).collect())


def test_late_rows_are_kept_and_repaired(spark, tmp_path):
    lake = Lake(str(tmp_path))
    how = {"sink": "parquet", "keep_late": True}
    land(lake, "a", click("u1", "10:00:00.000"), click("u2", "11:00:00.000"), line(user_id="u9", event_timestamp=LATER))
    stream(spark, lake, **how)
    assert late_table(spark, lake) == []
    land(lake, "b", click("u1", "10:20:00.000", event_id="late"), click("u9", "20:10:00.000", event_id="in time"), order=1)
    stream(spark, lake, **how)
    assert late_table(spark, lake) == ["late"]
    # nothing new: neither table changes
    stream(spark, lake, **how)
    assert late_table(spark, lake) == ["late"]
    assert jobs.repair_job(spark, lake, clean=False) == 2
    rows = read_table(spark, lake.stream_table(f"{NAME}_repaired")).collect()
    assert sorted((row["user_id"], row["num_events"], row["end_ts"]) for row in rows) == [
        ("u1", 2, at("10:20:00")), ("u2", 1, at("11:00:00")),
    ]
    # the stream's own table has the session as it was closed
    first = spark.read.parquet(lake.stream_table(NAME)).where("user_id = 'u1'").first()
    assert (first["num_events"], first["end_ts"]) == (1, at("10:00:00"))


def test_a_batch_of_late_rows_is_kept_once(spark, tmp_path):
    table, marks = str(tmp_path / "late"), str(tmp_path / "marks")
    run = late.keep_late(table, marks, 3600)
    rows = lambda *times: spark.createDataFrame([(at(t),) for t in times], "event_timestamp TIMESTAMP")
    for _ in range(2):
        run(rows("12:00", "09:00"), 0)
        run(rows("10:59", "11:00", "11:01"), 1)
    found = sorted(row["event_timestamp"] for row in read_table(spark, table).collect())
    assert found == [at("10:59"), at("11:00")]
    assert late.newest_event(spark, marks) == at("12:00") and late.newest_event(spark, marks, 0) is None
    run(rows(), 2)
    assert late.newest_event(spark, marks) == at("12:00")


def test_a_stream_goes_on_at_its_pace(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "10:00:00.000"), line(user_id="u9", event_timestamp=LATER))
    query = stream(spark, lake, wait=False, every="1 second")
    try:
        begin = time.time()
        while time.time() - begin < 60 and manifests.latest(spark, lake.stream_table(f"{NAME}_numbered")) is None:
            time.sleep(0.5)
        assert query.isActive
    finally:
        query.stop()
    assert told(spark, lake).count() in (0, 1)


def test_unknown_sink(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown sink"):
        jobs.stream_job(spark, Lake(str(tmp_path)), Settings(), sink="kafka")
