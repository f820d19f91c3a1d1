from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from conftest import at
from pyspark.sql import functions as F
from test_landing import line, put

from visitfold.lake import Lake, Settings
from visitfold.operators.sessions import build_sessions
from visitfold.plans import jobs
from visitfold.sources.landing import read_landing, stream_landing, type_events
from visitfold.sources.tables import read_table
from visitfold.streaming import live

LATER = "2026-08-01T20:00:00.000Z"


def click(user, time, **fields):
    return line(user_id=user, event_timestamp=f"2026-08-01T{time}Z", **fields)


def land(lake, name, *lines, order=0):
    """One landing file; files are read in order of their modification time."""
    put(Path(lake.landing), "2026-08-01", *lines, name=f"{name}.json.gz")
    moment = 1_785_000_000 + order
    os.utime(Path(lake.landing) / "event_date=2026-08-01" / f"{name}.json.gz", (moment, moment))


def run(spark, lake, **options):
    query = jobs.stream_job(spark, lake, sink="parquet", timeout=120, **options)
    assert query.exception() is None and not query.isActive
    return read_table(spark, lake.stream_table(query.name))


def starts(table):
    return sorted((r["user_id"], r["start_ts"].strftime("%H:%M")) for r in table.collect())


def test_sessions_close_and_the_tail_stays_open(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(
        lake,
        "a",
        click("u1", "10:00:00.000", event_type="page_view"),
        click("u1", "10:20:00.000", event_type="purchase"),
        click("u1", "11:00:00.000"),
        click("u2", "18:40:00.000"),  # window ends 19:10, watermark is 19:00
        line(user_id="u3", event_timestamp=LATER),
    )
    table = run(spark, lake)
    assert starts(table) == [("u1", "10:00"), ("u1", "11:00")]
    first = table.where("num_events = 2").first()
    assert (first["end_ts"], first["duration_sec"]) == (at("10:20:00"), 1200)
    assert first["window_end"] == at("10:50:00")
    assert first["num_pageviews"] == 1 and first["converted"] is True


def test_window_end_as_session_end(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "10:00:00.000"), line(user_id="u3", event_timestamp=LATER))
    (row,) = run(spark, lake, end="window").collect()
    assert (row["end_ts"], row["duration_sec"]) == (at("10:30:00"), 1800)


def test_stream_cleans_like_the_batch(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(
        lake,
        "a",
        click("u1", "10:00:00.000", event_type=" Page_View"),
        click("u1", "10:00:00.000", event_type="page_view"),  # copy
        click("u1", "10:00:01.000", event_type=None),
        click("bot", "10:00:00.000", user_agent="Googlebot"),
        line(user_id=None),
        line(event_timestamp="soon"),
        line(user_id="u3", event_timestamp=LATER),
    )
    (row,) = run(spark, lake).collect()
    assert (row["user_id"], row["num_events"], row["num_pageviews"]) == ("u1", 1, 1)


def test_raw_stream_keeps_bots_and_copies(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(
        lake,
        "a",
        click("bot", "10:00:00.000", user_agent="Googlebot"),
        click("bot", "10:00:00.000", user_agent="Googlebot"),
        line(user_id="u3", event_timestamp=LATER),
    )
    (row,) = run(spark, lake, clean=False).collect()
    assert (row["user_id"], row["num_events"]) == ("bot", 2)


@pytest.mark.parametrize("files_per_batch", [1, 10])
def test_equals_batch_for_closed_sessions(spark, tmp_path, files_per_batch):
    lake = Lake(str(tmp_path))
    for hour in range(6):
        land(
            lake,
            f"h{hour}",
            *[
                click(f"u{n % 3}", f"{10 + hour}:{(n * 5) % 25:02}:{n:02}.250", path=f"/{n}")
                for n in range(12)
            ],
            order=hour,
        )
    streamed = run(spark, lake, files_per_batch=files_per_batch)
    events = jobs.silver_events(type_events(read_landing(spark, lake.landing)))
    closed = events.agg(F.max("event_timestamp") - F.expr("INTERVAL 90 MINUTES")).first()[0]
    names = ["user_id", "start_ts", "end_ts", "duration_sec", "num_events", "num_pageviews", "converted"]
    batch = build_sessions(events, exact=True).where(F.col("end_ts") <= F.lit(closed)).select(*names)
    streamed = streamed.select(*names)
    assert batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_late_rows_are_dropped_one_batch_behind(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "12:00:00.000"), order=1)  # watermark 11:00 from batch b on
    land(lake, "b", click("u2", "16:00:00.000"), order=2)  # watermark 15:00 from batch c on
    land(lake, "c", click("late", "10:00:00.000"), click("u3", "15:30:00.000"), order=3)
    land(lake, "d", line(user_id="end", event_timestamp=LATER), order=4)
    with pytest.raises(RuntimeError, match="1 rows came after the watermark"):
        jobs.stream_job(spark, lake, sink="parquet", files_per_batch=1)
    # what came in time is written all the same
    assert starts(read_table(spark, lake.stream_table("live_sessions"))) == [
        ("u1", "12:00"),
        ("u2", "16:00"),
        ("u3", "15:30"),
    ]


def test_row_behind_the_next_watermark_is_accepted_once(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u2", "16:00:00.000"), click("early", "10:00:00.000"), order=1)
    land(lake, "b", line(user_id="end", event_timestamp=LATER), order=2)
    assert ("early", "10:00") in starts(run(spark, lake, files_per_batch=1))


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "10:00:00.000"), click("u1", "14:00:00.000"))
    assert starts(run(spark, lake)) == [("u1", "10:00")]
    land(lake, "b", click("u1", "14:10:00.000"), line(user_id="end", event_timestamp=LATER), order=9)
    table = run(spark, lake)
    assert starts(table) == [("u1", "10:00"), ("u1", "14:00")]
    assert table.where("num_events = 2").count() == 1  # the open session was kept in state


def test_console_does_not_use_up_the_table_input(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "10:00:00.000"), line(user_id="end", event_timestamp=LATER))
    query = jobs.stream_job(spark, lake, sink="console", timeout=120)
    assert query.exception() is None
    assert "Console" in query.lastProgress["sink"]["description"]
    assert starts(run(spark, lake)) == [("u1", "10:00")]


def test_unawaited_query_is_returned(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "10:00:00.000"))
    query = jobs.stream_job(spark, lake, sink="parquet", wait=False)
    assert query.name == "live_sessions"
    assert query.awaitTermination(120)


@pytest.fixture(scope="module")
def shuffled_hours():
    """24 files of an hour each, with modification times in no order."""
    order = list(range(24))
    random.Random(6).shuffle(order)

    def build(lake):
        for hour, place in enumerate(order):
            users = [f"u{n}" for n in range(hour % 3, 8, 3)]
            land(lake, f"h{hour:02}", *[click(u, f"{hour:02}:{7 * int(u[1]):02}:00.000") for u in users], order=place)
        newest = line(user_id="end", event_timestamp="2026-08-04T00:00:00.000Z")
        land(lake, "zz", newest, order=99)

    return build


def test_sessions_do_not_depend_on_the_batch_size(spark, tmp_path, shuffled_hours):
    found = []
    for files_per_batch in (1, 8, 1000):
        lake = Lake(str(tmp_path / str(files_per_batch)))
        shuffled_hours(lake)
        day = Settings(lateness_seconds=24 * 3600)
        query = jobs.stream_job(spark, lake, day, sink="parquet", files_per_batch=files_per_batch)
        rows = read_table(spark, lake.stream_table(query.name)).collect()
        found.append(sorted(tuple(r) for r in rows))
    assert found[0] == found[1] == found[2]
    assert sum(row[4] for row in found[0]) == sum(len(range(hour % 3, 8, 3)) for hour in range(24))


def test_too_little_lateness_is_told(spark, tmp_path, shuffled_hours):
    for files_per_batch, late in ((1, True), (1000, False)):
        lake = Lake(str(tmp_path / str(files_per_batch)))
        shuffled_hours(lake)
        options = {"sink": "parquet", "files_per_batch": files_per_batch}
        if late:
            with pytest.raises(RuntimeError, match="lateness_seconds above 3600"):
                jobs.stream_job(spark, lake, **options)
        else:
            jobs.stream_job(spark, lake, **options)


def test_late_rows_may_be_allowed(spark, tmp_path, shuffled_hours):
    lake = Lake(str(tmp_path))
    shuffled_hours(lake)
    query = jobs.stream_job(spark, lake, sink="parquet", files_per_batch=1, allow_late=True)
    assert 0 < read_table(spark, lake.stream_table(query.name)).count() < 60


def test_state_is_kept_by_rocksdb(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "10:00:00.000"))
    query = jobs.stream_job(spark, lake, sink="parquet")
    metrics = query.lastProgress["stateOperators"][0]["customMetrics"]
    assert any(name.startswith("rocksdb") for name in metrics)


def test_unknown_sink(spark, tmp_path):
    with pytest.raises(ValueError, match="sink"):
        jobs.stream_job(spark, Lake(str(tmp_path)), sink="kafka")


def test_complete_mode_shows_open_sessions(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake, "a", click("u1", "10:00:00.000"), click("u1", "10:10:00.000"))
    events = live.with_lateness(stream_landing(spark, lake.landing), Settings().watermark_seconds)
    checkpoint = lake.checkpoint("open_sessions", "memory")
    writer = live.drain(live.live_sessions(events), "open_sessions", checkpoint, "complete")
    query = writer.format("memory").start()
    query.awaitTermination(120)
    (row,) = spark.table("open_sessions").collect()
    assert row["num_events"] == 2 and row["end_ts"] == at("10:10:00")


def test_batch_size_limits_files(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for n in range(4):
        land(lake, f"f{n}", click("u1", f"1{n}:00:00.000"), order=n)
    query = jobs.stream_job(spark, lake, sink="parquet", files_per_batch=2, timeout=120)
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes == [2, 2]
