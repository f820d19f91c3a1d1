"""Tables that are replaced whole or not at all, and the ledger of landing files."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import textwrap
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_landing import line, put
from visitfold.lake import Lake
from visitfold.plans import jobs
from visitfold.sources import ledger, manifests
from visitfold.sources.files import Folder
from visitfold.sources.tables import drop_days, read_table, stage_table, table_days, write_table


def numbers(spark, *days, value=1):
    rows = [(value, day) for day in days]
    return spark.createDataFrame(rows, "value INT, event_date STRING").withColumn(
        "event_date", F.col("event_date").cast("date")
    )


def held(spark, path, **span):
    rows = read_table(spark, path, **span).collect()
    return Counter((row["value"], row["event_date"] and str(row["event_date"])) for row in rows)


def test_days_are_replaced_added_and_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two, three = "2026-08-01", "2026-08-02", "2026-08-03"
    write_table(numbers(spark, one, two, None), path, ["event_date"])
    write_table(numbers(spark, two, value=2), path, ["event_date"], replace="days")
    assert held(spark, path) == {(1, one): 1, (2, two): 1, (1, None): 1}
    write_table(numbers(spark, two, three, value=3), path, ["event_date"], replace="add")
    assert held(spark, path) == {(1, one): 1, (2, two): 1, (3, two): 1, (3, three): 1, (1, None): 1}
    assert held(spark, path, since=two, until=two) == {(2, two): 1, (3, two): 1}
    # days of the span go also where they get no rows
    write_table(numbers(spark, three, value=4), path, ["event_date"], replace="days", span=(two, None))
    assert held(spark, path) == {(1, one): 1, (4, three): 1, (1, None): 1}
    drop_days(spark, path, since=three)
    assert held(spark, path) == {(1, one): 1, (1, None): 1} and table_days(spark, path) == [one]
    drop_days(spark, str(tmp_path / "absent"), since=three)
    assert manifests.latest(spark, str(tmp_path / "absent")) is None


def test_a_load_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        write_table(numbers(spark, "2026-08-01"), path, ["event_date"], replace="add", load="batch-0")
    assert read_table(spark, path).count() == 1
    # a table that is replaced forgets its loads
    write_table(numbers(spark, "2026-08-01"), path, ["event_date"])
    assert manifests.latest(spark, path).loads == ()


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbers(spark, "2026-08-01", "2026-08-02"), path, ["event_date"])
    before = held(spark, path)
    rows = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("value"),
        F.lit("2026-08-01").cast("date").alias("event_date"),
    )
    with pytest.raises(Exception, match="lost"):
        write_table(rows, path, ["event_date"])
    assert held(spark, path) == before


def test_a_killed_job_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbers(spark, "2026-08-01", "2026-08-02"), path, ["event_date"])
    before = held(spark, path)
    job = textwrap.dedent(
        f"""
        from pyspark.sql import SparkSession, functions as F
        from visitfold.sources.tables import write_table
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        slow = F.udf(lambda n: __import__("time").sleep(0.02) or n, "long")
        rows = spark.range(0, 100000, 1, 2000).select(slow("id").cast("int").alias("value"),
            F.lit("2026-08-01").cast("date").alias("event_date"))
        write_table(rows, {path!r}, ["event_date"])
        """
    )
    running = subprocess.Popen(
        [sys.executable, "-c", job], cwd=Path(__file__).parent.parent, start_new_session=True,
        stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL,
    )
    try:
        begin = time.time()
        written = lambda: len(list((tmp_path / "t").rglob("*.parquet")))
        while written() < 4 and time.time() - begin < 120 and running.poll() is None:
            time.sleep(0.2)
        assert running.poll() is None and written() >= 4
    finally:
        os.killpg(running.pid, signal.SIGKILL)
        running.wait()
    assert len(list((tmp_path / "t").glob("version=*"))) == 2
    assert held(spark, path) == before
    # the next job is not disturbed by what is left
    write_table(numbers(spark, "2026-08-01", value=9), path, ["event_date"])
    assert held(spark, path) == {(9, "2026-08-01"): 1}


def test_a_reader_keeps_what_it_has_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbers(spark, "2026-08-01", value=1), path, ["event_date"])
    old = read_table(spark, path)
    write_table(numbers(spark, "2026-08-01", value=2), path, ["event_date"])
    assert [row["value"] for row in old.collect()] == [1]
    # a job may replace what it reads
    write_table(read_table(spark, path).withColumn("value", F.col("value") + 1), path, ["event_date"])
    assert held(spark, path) == {(3, "2026-08-01"): 1}


def test_two_writers_do_not_lose_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbers(spark, "2026-08-01"), path)
    one, two = (stage_table(numbers(spark, "2026-08-02", value=v), path) for v in (1, 2))
    seen = manifests.latest(spark, path)
    one.publish()
    with pytest.raises(FileExistsError):
        manifests.commit(spark, path, manifests.renumbered(seen))
    assert held(spark, path) == {(1, "2026-08-02"): 1}
    two.publish()
    assert held(spark, path) == {(2, "2026-08-02"): 1}


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in range(4):
        write_table(numbers(spark, "2026-08-01", value=value), path, ["event_date"])
    staged = stage_table(numbers(spark, "2026-08-02", value=7), path, ["event_date"])
    assert len(manifests.expire(spark, path, keep=2)) == 2
    assert len(list((tmp_path / "t").glob("version=*"))) == 3
    assert held(spark, path) == {(3, "2026-08-01"): 1}
    staged.publish("add")
    assert held(spark, path) == {(3, "2026-08-01"): 1, (7, "2026-08-02"): 1}


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    path = str(tmp_path / "t")
    numbers(spark, "2026-08-01", "2026-08-02").write.partitionBy("event_date").parquet(path)
    assert held(spark, path, since="2026-08-02") == {(1, "2026-08-02"): 1}


def test_files_are_created_whole(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == []
    folder.create("a", "text é")
    with pytest.raises(FileExistsError):
        folder.create("a", "other")
    assert folder.read("a") == "text é"
    assert [name for name in folder.names() if not name.startswith(".")] == ["a"]


# ---- ledger -------------------------------------------------------------------


def landed(number, day, **more):
    return line(event_id=str(number), event_timestamp=f"{day}T10:00:00.000Z", **more)


def drop_file(tmp_path, day, *lines):
    put(tmp_path / "landing", day, *lines)


def ids(spark, lake, table="bronze"):
    return sorted(row[0] for row in read_table(spark, getattr(lake, table)).select("event_id").collect())


@pytest.fixture
def lake(spark, tmp_path):
    drop_file(tmp_path, "2026-08-01", landed(1, "2026-08-01"), landed(2, "2026-08-01", user_id="u2"))
    drop_file(tmp_path, "2026-08-02", landed(3, "2026-08-02"), landed(4, "2026-08-03"))
    found = Lake(str(tmp_path))
    assert jobs.load_job(spark, found) == (4, ["2026-08-01", "2026-08-02", "2026-08-03"])
    return found


def test_a_load_reads_new_files_only(spark, lake, tmp_path):
    assert jobs.load_job(spark, lake) == (0, [])
    drop_file(tmp_path, "2026-08-09", landed(5, "2026-08-02"))
    listed = ledger.list_landing(spark, lake.landing)
    new = ledger.new_files(listed, ledger.known_files(spark, lake.ledger, lake.bronze))
    assert ["2026-08-09" in path for path in ledger.paths_of(new)] == [True]
    old = {f for f in read_table(spark, lake.bronze).inputFiles()}
    assert jobs.load_job(spark, lake) == (1, ["2026-08-02"])
    assert ids(spark, lake) == ["1", "2", "3", "4", "5"]
    assert old < set(read_table(spark, lake.bronze).inputFiles())


def test_a_range_reads_files_that_overlap_it(spark, lake, tmp_path):
    files = jobs.range_files(spark, lake, "2026-08-03", "2026-08-03")
    assert ["event_date=2026-08-02" in path for path in files] == [True]
    assert jobs.range_files(spark, lake, "2026-09-01", None) == []
    assert jobs.bronze_job(spark, lake, since="2026-08-03", until="2026-08-03") == 1
    assert ids(spark, lake) == ["1", "2", "3", "4"]
    # files that no load has read may hold any day
    drop_file(tmp_path, "2026-08-09", landed(5, "2026-08-03"), landed(6, "2026-08-01"))
    assert jobs.bronze_job(spark, lake, since="2026-08-03", until="2026-08-03") == 2
    assert ids(spark, lake) == ["1", "2", "3", "4", "5"]


def test_changed_and_removed_files(spark, lake, tmp_path):
    for path in (tmp_path / "landing" / "event_date=2026-08-01").iterdir():
        path.unlink()
    drop_file(tmp_path, "2026-08-01", landed(1, "2026-08-01"), landed(7, "2026-08-04"), "no json")
    assert jobs.load_job(spark, lake)[1] == ["2026-08-01", "2026-08-04"]
    rows = read_table(spark, lake.bronze)
    assert sorted(row[0] or "" for row in rows.select("event_id").collect()) == ["", "1", "3", "4", "7"]
    for path in (tmp_path / "landing" / "event_date=2026-08-02").iterdir():
        path.unlink()
    assert jobs.load_job(spark, lake)[1] == ["2026-08-02", "2026-08-03"]
    rows = read_table(spark, lake.bronze)
    assert sorted(row[0] or "" for row in rows.select("event_id").collect()) == ["", "1", "7"]
    assert jobs.load_job(spark, lake) == (0, [])


def test_a_load_that_was_cut_short_is_run_again(spark, lake, tmp_path, monkeypatch):
    drop_file(tmp_path, "2026-08-05", landed(8, "2026-08-05"))
    publish = jobs.stage_table

    def stops(*args):
        staged = publish(*args)
        object.__setattr__(staged, "publish", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("stopped")))
        return staged

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "stage_table", stops)
        with pytest.raises(RuntimeError, match="stopped"):
            jobs.load_job(spark, lake)
    assert ids(spark, lake) == ["1", "2", "3", "4"]
    assert jobs.load_job(spark, lake) == (1, ["2026-08-05"])
    assert ids(spark, lake) == ["1", "2", "3", "4", "8"]


def test_refresh_follows_the_landing_zone(spark, lake, tmp_path):
    tables = lambda root: {
        name: sorted(map(str, read_table(spark, path).collect()))
        for name, path in [("sessions", root.sessions), ("top", root.gold("top_paths")), ("funnel", root.gold("funnel"))]
    }
    jobs.silver_job(spark, lake)
    jobs.sessions_job(spark, lake)
    drop_file(tmp_path, "2026-08-07", landed(9, "2026-08-02", path="/late"), landed(10, "2026-08-05"))
    rows = jobs.refresh_job(spark, lake)
    assert rows["bronze"] == 2 and rows["gold/funnel"] == 3
    assert jobs.refresh_job(spark, lake) == {"bronze": 0, "silver": 0, "sessions": 0}
    fast = tables(lake)
    jobs.batch_job(spark, lake)
    assert tables(lake) == fast


def test_spans_of_days():
    assert jobs.spans([]) == []
    assert jobs.spans(["2026-08-31", "2026-09-01", "2026-09-03"]) == [
        ("2026-08-31", "2026-09-01"), ("2026-09-03", "2026-09-03"),
    ]
