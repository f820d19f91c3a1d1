from __future__ import annotations

import gzip
import json
from datetime import date
from pathlib import Path

import pytest
from conftest import at, plan
from pyspark.sql import functions as F

from visitfold.lake import Lake, Settings
from visitfold.operators.sessions import build_sessions
from visitfold.plans import jobs
from visitfold.sources import scratch
from visitfold.sources.landing import day_spans, read_landing, rows_per_day, type_events, write_landing
from visitfold.sources.tables import read_table, write_table


def line(**fields):
    base = {
        "event_id": "1",
        "user_id": "u1",
        "event_timestamp": "2026-08-01T10:00:00.000Z",
        "event_type": "page_view",
        "path": "/a",
        "referrer": "direct",
        "device": "mobile",
        "country": "us",
        "user_agent": "Safari",
    }
    return json.dumps(base | fields)


def put(folder: Path, day: str, *lines: str, name: str = "events.json.gz"):
    target = folder / f"event_date={day}"
    target.mkdir(parents=True, exist_ok=True)
    with gzip.open(target / name, "wt") as file:
        file.write("\n".join(lines))


def test_typed_bronze(spark, tmp_path):
    put(tmp_path, "2026-08-01", line(), line(event_id="2", user_id=None))
    put(tmp_path, "2026-08-02", line(event_id="3", event_timestamp="2026-08-02T23:59:59.000Z"))
    events = type_events(read_landing(spark, str(tmp_path)))
    rows = {r["event_id"]: r for r in events.collect()}
    assert rows["1"]["event_timestamp"] == at("10:00:00")
    assert rows["3"]["event_date"] == date(2026, 8, 2)
    assert rows["2"]["user_id"] is None  # nothing is dropped
    assert all("events.json.gz" in r["source_file"] and r["ingest_ts"] for r in rows.values())
    assert dict(events.dtypes)["event_timestamp"] == "timestamp"


def test_day_comes_from_the_event_not_the_folder(spark, tmp_path):
    put(tmp_path, "2026-09-30", line())
    row = type_events(read_landing(spark, str(tmp_path))).first()
    assert row["event_date"] == date(2026, 8, 1)


def test_damaged_lines_and_times_are_kept(spark, tmp_path):
    put(tmp_path, "2026-08-01", line(), '{"event_id": "2", "us', line(event_id="3", event_timestamp="soon"))
    events = type_events(read_landing(spark, str(tmp_path)))
    rows = {r["event_id"]: r for r in events.collect()}
    assert rows[None]["corrupt_line"] == '{"event_id": "2", "us'
    assert rows["3"]["event_timestamp"] is None and rows["3"]["corrupt_line"] is None
    assert jobs.silver_events(events).count() == 1


def test_landing_keeps_microseconds(spark, tmp_path):
    events = spark.createDataFrame(
        [("1", "u1", at("2026-08-01 10:00:00.123456"), "click", "/a", None, None, None, None)],
        "event_id STRING, user_id STRING, event_timestamp TIMESTAMP, event_type STRING, path STRING, "
        "referrer STRING, device STRING, country STRING, user_agent STRING",
    )
    path = str(tmp_path / "landing")
    write_landing(events, path)
    (row,) = type_events(read_landing(spark, path)).collect()
    assert row["event_timestamp"] == at("2026-08-01 10:00:00.123456")
    files = list(Path(path).glob("event_date=2026-08-01/*.json.gz"))
    assert len(files) == 1
    with gzip.open(files[0], "rt") as file:
        assert "event_date" not in json.loads(file.readline())
    assert [tuple(r) for r in rows_per_day(events).collect()] == [(date(2026, 8, 1), 1)]


def days(spark):
    return spark.range(100).select(
        F.col("id"), F.expr("date_add(DATE'2026-08-01', CAST(id % 4 AS INT))").alias("event_date")
    )


@pytest.mark.parametrize("gather", [False, True])
def test_written_rows_are_counted(spark, tmp_path, gather):
    path = str(tmp_path / "t")
    assert write_table(days(spark), path, ["event_date"], gather=gather) == 100
    assert write_table(days(spark).limit(7), path, ["event_date"], gather=gather) == 7
    assert read_table(spark, path).count() == 7


def test_gathered_days_make_few_files(spark, tmp_path):
    path = tmp_path / "t"
    write_table(days(spark).repartition(8), str(path), ["event_date"], gather=True)
    assert len(list(path.glob("version=*/event_date=*/*.parquet"))) == 4


def test_empty_table_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(days(spark).where("id < 0"), path) == 0
    assert read_table(spark, path).count() == 0


def test_unknown_day_is_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = days(spark).limit(3).withColumn("event_date", F.lit(None).cast("date"))
    assert write_table(rows, path, ["event_date"], gather=True) == 3
    assert read_table(spark, path).where("event_date IS NULL").count() == 3


def test_day_bounds_prune_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(days(spark), path, ["event_date"])
    some = read_table(spark, path, since="2026-08-02", until=date(2026, 8, 3))
    assert some.count() == 50
    filters = next(s for s in plan(some).split("PartitionFilters: ")[1:])
    assert "event_date" in filters.split("PushedFilters")[0]


def test_lake_paths_keep_their_scheme():
    lake = Lake("s3a://bucket/lake/")
    assert lake.bronze == "s3a://bucket/lake/bronze"
    assert lake.gold("funnel") == "s3a://bucket/lake/gold/funnel"
    assert lake.checkpoint("q", "console") != lake.checkpoint("q", "parquet")


def test_batch_job(spark, tmp_path):
    lake = Lake(str(tmp_path))
    put(
        tmp_path / "landing",
        "2026-08-01",
        line(),
        line(),
        line(event_id="2", event_timestamp="2026-08-01T10:10:00.000Z", event_type="add_to_cart"),
        line(event_id="3", event_timestamp="2026-08-01T12:00:00.000Z", event_type="PURCHASE"),
        line(event_id="4", user_id="u2"),
        line(event_id="5", user_id=None),
        line(event_id="6", user_agent="AhrefsBot/7.0"),
    )
    assert jobs.batch_job(spark, lake) == {
        "bronze": 7,
        "silver": 4,
        "gold/key_skew_report": 2,
        "gold/skew_check": 1,
        "sessions": 3,
        "gold/funnel": 3,
        "gold/daily_sessions": 1,
        "gold/top_paths": 1,
        "gold/returning_users": 1,
    }
    funnel = {r["stage"]: r["count"] for r in read_table(spark, lake.gold("funnel")).collect()}
    assert funnel == {"1_view": 2, "2_add_to_cart": 1, "3_purchase": 1}
    sessions = read_table(spark, lake.sessions)
    again = build_sessions(read_table(spark, lake.silver), Settings().gap_seconds)
    assert sessions.select(*again.columns).exceptAll(again).count() == 0
    assert tuple(read_table(spark, lake.gold("returning_users")).first()) == (2, 1, 0.5)
    check = read_table(spark, lake.gold("skew_check")).first()
    assert (check["naive_total_events"], check["totals_match"]) == (4, 1)
    hottest = read_table(spark, lake.gold("key_skew_report")).orderBy("event_count").collect()
    assert [tuple(r) for r in hottest] == [("u2", 1), ("u1", 3)]


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = (scratch.scratch_dir(spark, "x") for _ in range(2))
    assert one.startswith(shared) and two.startswith(shared) and one != two


def test_scratch_lies_in_the_warehouse_without_a_shared_folder():
    class Conf:
        def get(self, name, default=None):
            return "hdfs://store/warehouse/" if name == "spark.sql.warehouse.dir" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    assert scratch.scratch_dir(Session(), "x").startswith("hdfs://store/warehouse/x-")


def test_spans_of_days_are_written_one_after_another(spark, tmp_path):
    """Days as far apart as the lateness lie in different spans, and every line is there."""
    rows = [(f"e{n}", f"u{n % 3}", f"2026-08-{1 + n % 28:02}T10:00:00.000Z") for n in range(280)]
    rows.append(("lost", "u1", "soon"))
    lines = spark.createDataFrame(rows, "event_id STRING, user_id STRING, event_timestamp STRING")
    others = ["event_type", "path", "referrer", "device", "country", "user_agent"]
    lines = lines.selectExpr("*", *[f"CAST(NULL AS STRING) AS {name}" for name in others])
    write_landing(lines.repartition(8), str(tmp_path), days_at_once=7)
    assert read_landing(spark, str(tmp_path)).select("event_id").distinct().count() == 281
    files = sorted(tmp_path.rglob("*.gz"), key=lambda path: path.stat().st_mtime_ns)
    days = [path.parent.name.removeprefix("event_date=") for path in files]
    weeks = [(int(day[-2:]) - 1) // 7 if day[:4] == "2026" else -1 for day in days]
    assert weeks == sorted(weeks) and set(weeks) == {-1, 0, 1, 2, 3}


def test_spans_hold_all_days():
    days = ["2026-02-27", "2026-03-01", "2026-03-02", "2026-08-01"]
    assert day_spans(days, 3) == [("2026-02-27", "2026-03-01"), ("2026-03-02", "2026-03-02"), ("2026-08-01", "2026-08-01")]
    assert day_spans([], 3) == []
