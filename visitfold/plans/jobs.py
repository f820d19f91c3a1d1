"""The batch layers, the skew comparison and the streaming job."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from visitfold.lake import Lake, Settings
from visitfold.operators import arrivals, kpis, skew
from visitfold.operators.cleaning import clean_events, drop_repeats, identified
from visitfold.operators.dimensions import enrich
from visitfold.operators.sessions import window_sessions
from visitfold.plans.sessions_job import sessions_job
from visitfold.sources import ledger, manifests
from visitfold.sources.landing import CORRUPT, READ_SCHEMA, read_landing, stream_landing, type_events
from visitfold.sources.scratch import scratch_dir
from visitfold.sources.tables import (
    between_days,
    drop_days,
    read_table,
    stage_table,
    table_days,
    table_exists,
    write_table,
)
from visitfold.streaming import late, live, numbered


def silver_events(bronze: DataFrame) -> DataFrame:
    """Clean, single, enriched events of people."""
    return enrich(drop_repeats(clean_events(bronze.drop(CORRUPT))))


def bronze_job(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    since: str | date | None = None,
    until: str | date | None = None,
) -> int:
    """All days anew, or only those from ``since`` up to and including ``until``.

    Folder names of the landing zone are not believed. A range reads the files that the
    ledger says overlap it, and those that no load has read yet.
    """
    if since is None and until is None:
        return _load(spark, lake, settings, ledger.list_landing(spark, lake.landing), whole=True)[0]
    files = range_files(spark, lake, since, until)
    rows = read_landing(spark, files) if files else _nothing_landed(spark)
    events = between_days(type_events(rows), since, until)
    days = list(settings.partition_by)
    return write_table(events, lake.bronze, days, replace="days", span=(since, until))


def range_files(
    spark: SparkSession, lake: Lake, since: str | date | None = None, until: str | date | None = None
) -> list[str]:
    """Landing files that a load of some days has to read."""
    listed = ledger.list_landing(spark, lake.landing)
    known = ledger.known_files(spark, lake.ledger, lake.bronze)
    there = ledger.overlapping(known, since, until).join(listed.select(*ledger.SEEN), ledger.SEEN, "left_semi")
    return ledger.paths_of(there.select("path").unionByName(ledger.new_files(listed, known).select("path")))


def load_job(spark: SparkSession, lake: Lake, settings: Settings = Settings()) -> tuple[int, list[str]]:
    """Add landing files that no load has read to bronze; rows added and days that changed.

    Rows of a file that is gone or has changed since it was read leave bronze; the days that
    held them are written again from what bronze has of the other files. The days are those
    that silver and the layers behind it have to follow.
    """
    listed = ledger.list_landing(spark, lake.landing)
    known = _written(ledger.known_files(spark, lake.ledger, lake.bronze), "known")
    altered = _written(ledger.altered_files(listed, known), "altered")
    return _load(spark, lake, settings, ledger.new_files(listed, known), altered=altered)


def _load(
    spark: SparkSession,
    lake: Lake,
    settings: Settings,
    files: DataFrame,
    whole: bool = False,
    altered: DataFrame | None = None,
) -> tuple[int, list[str]]:
    load = uuid.uuid4().hex
    files = _written(files, "files")
    paths = ledger.paths_of(files)
    stale_days: list[str] = []
    # Map-only: a landing file holds one day, so each task writes few files as it is.
    events = type_events(read_landing(spark, paths) if paths else _nothing_landed(spark))
    if altered is not None and not altered.isEmpty():
        bronze = read_table(spark, lake.bronze)
        stale = bronze.join(altered.select("source_file"), "source_file", "left_semi")
        touched = [row[0] for row in stale.select("event_date").distinct().collect()]
        stale_days = [manifests.NO_DAY if day is None else str(day) for day in touched]
        others = bronze.where(F.coalesce(F.col("event_date").isin([day for day in touched if day]), F.lit(None in touched)))
        others = others.join(altered.select("source_file"), "source_file", "left_anti")
        events = events.unionByName(others)
    elif not paths and not whole:
        return 0, []
    staged = stage_table(events, lake.bronze, list(settings.partition_by))
    entries = ledger.describe(files, staged.rows(), load)
    if altered is not None:
        vanished = altered.join(files.select("source_file"), "source_file", "left_anti")
        entries = entries.unionByName(ledger.tombstones(vanished, load))
    write_table(entries, lake.ledger, replace="table" if whole else "add", load=load)
    staged.publish("table" if whole else "add", days=stale_days, load=load)
    return staged.count, sorted({*staged.days(), *stale_days} - {manifests.NO_DAY})


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, label)
    write_table(rows, path)
    return read_table(rows.sparkSession, path)


def _nothing_landed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{READ_SCHEMA}, source_file STRING")


def silver_job(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    since: str | date | None = None,
    until: str | date | None = None,
) -> int:
    """All days, or a range: copies have equal times, so a day's rows depend on that day alone."""
    events = silver_events(read_table(spark, lake.bronze, since, until))
    drop_days(spark, lake.silver_keys, since, until)
    days, whole = list(settings.partition_by), since is None and until is None
    return write_table(
        events, lake.silver, days, gather=True, replace="table" if whole else "days", span=(since, until)
    )


def append_silver_job(
    spark: SparkSession, lake: Lake, bronze: DataFrame, load: str, settings: Settings = Settings()
) -> tuple[int, list[str]]:
    """Add the events of some bronze rows that silver does not have yet; rows added and their days.

    Stored days are not written again, and not shuffled but for their keys where a load is large
    next to them. ``load`` names the rows: what was added under that name is not added twice.
    """
    events = silver_events(bronze)
    if table_exists(spark, lake.silver):
        events = _written(events, "arrivals")
        _complete_bitmaps(spark, lake, events)
        stored = read_table(spark, lake.silver)
        if arrivals.is_large(events, stored):
            events = arrivals.compared(events, stored)
        else:
            told = _written(arrivals.maybe_stored(events, read_table(spark, lake.silver_keys)), "told")
            events = arrivals.not_stored(told, stored)
    days = list(settings.partition_by)
    staged = stage_table(events, lake.silver, days, gather=True)
    bitmaps = arrivals.day_bitmaps(staged.rows())
    write_table(bitmaps, lake.silver_keys, ["event_date"], replace="add", load=load)
    return staged.publish("add", load=load), staged.days()


def _complete_bitmaps(spark: SparkSession, lake: Lake, events: DataFrame) -> None:
    """Bitmaps for stored days of these events that have none: silver was built another way."""
    told = {str(row[0]) for row in events.select("event_date").distinct().collect()}
    lacking = sorted(told & set(table_days(spark, lake.silver)) - set(table_days(spark, lake.silver_keys)))
    if lacking or not table_exists(spark, lake.silver_keys):
        stored = read_table(spark, lake.silver).where(F.col("event_date").isin([date.fromisoformat(day) for day in lacking]))
        write_table(arrivals.day_bitmaps(stored), lake.silver_keys, ["event_date"], replace="add")


# The gold tables and the layer that each is made from.
GOLD = {
    "funnel": "silver",
    "daily_sessions": "sessions",
    "top_paths": "sessions",
    "returning_users": "sessions",
}


def gold_table(name: str, rows: DataFrame, settings: Settings) -> DataFrame:
    """A gold table from the rows of its layer."""
    if name == "funnel":
        return kpis.funnel(rows)
    if name == "daily_sessions":
        return kpis.daily_sessions(rows)
    if name == "top_paths":
        return kpis.top_paths(rows, settings.top_paths)
    return kpis.returning_users(rows)


def gold_job(
    spark: SparkSession, lake: Lake, settings: Settings = Settings(), only: Collection[str] = tuple(GOLD)
) -> dict[str, int]:
    """Gold tables, all or some; rows of each."""
    paths = {"silver": lake.silver, "sessions": lake.sessions}
    return {
        name: write_table(gold_table(name, read_table(spark, paths[layer]), settings), lake.gold(name))
        for name, layer in GOLD.items()
        if name in only
    }


def skew_job(spark: SparkSession, lake: Lake, settings: Settings = Settings()) -> dict[str, int]:
    """How uneven users are, and that salting the heavy ones changes no count.

    Plain counts are written once; report, heavy users and comparison read them.
    """
    events = read_table(spark, lake.silver)
    counts = skew.written_counts(events)
    heavy = skew.heavy_keys(counts, settings.spread_parts, threshold=settings.hot_threshold)
    tables = {
        "key_skew_report": skew.largest_keys(counts, settings.top_keys),
        "skew_check": skew.skew_check(
            events, settings.salt_factor, hot=heavy, spread_by=["event_id"], naive=counts
        ),
    }
    return {name: write_table(table, lake.gold(name)) for name, table in tables.items()}


def batch_job(spark: SparkSession, lake: Lake, settings: Settings = Settings()) -> dict[str, int]:
    """Rebuild every layer from the landing zone; rows per table."""
    rows = {
        "bronze": bronze_job(spark, lake, settings),
        "silver": silver_job(spark, lake, settings),
    }
    gold = skew_job(spark, lake, settings)
    rows["sessions"] = sessions_job(spark, lake, settings)
    gold |= gold_job(spark, lake, settings)
    return rows | {f"gold/{name}": count for name, count in gold.items()}


def refresh_job(spark: SparkSession, lake: Lake, settings: Settings = Settings()) -> dict[str, int]:
    """Bring all layers up to date with the landing zone; rows per table, as far as written.

    Reads the files that no load has read, and of each layer the days that change.
    """
    added, days = load_job(spark, lake, settings)
    rows = {"bronze": added, "silver": 0, "sessions": 0}
    for since, until in spans(days):
        rows["silver"] += silver_job(spark, lake, settings, since, until)
        rows["sessions"] += sessions_job(spark, lake, settings, since, until)
    if days:
        rows |= {f"gold/{name}": count for name, count in gold_job(spark, lake, settings).items()}
    return rows


def spans(days: list[str]) -> list[tuple[str, str]]:
    """Runs of consecutive days, first and last."""
    out: list[tuple[str, str]] = []
    for day in sorted(days):
        if out and date.fromisoformat(day) - date.fromisoformat(out[-1][1]) == timedelta(days=1):
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


SINKS = ("console", "parquet", "table")


def stream_job(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    *,
    sink: str = "console",
    clean: bool = True,
    end: str = "last_event",
    files_per_batch: int = 1000,
    wait: bool = True,
    timeout: int | None = None,
    allow_late: bool = False,
    keep_late: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Sessions of everything in the landing zone that no earlier run has read.

    ``clean=False`` keeps bots and copies in. ``sink`` is ``console``, ``parquet``, or
    ``table``: all columns of the sessions layer, with index and id, partitioned by day. Each
    keeps its own progress. With ``every`` the stream does not stop but runs at that pace.

    Files are read by modification time, ``files_per_batch`` at a time, and a batch drops
    what is older than the newest event of the batches before it less the lateness. Results
    do not depend on the batch size as long as the lateness covers that disorder. A waited
    run that dropped rows raises, unless ``allow_late``; its sessions are written all the
    same. ``keep_late`` first writes such rows to a table, for ``repair_job``. History that
    lies in no order belongs to the batch job.
    """
    if sink not in SINKS:
        raise ValueError(f"unknown sink: {sink}")
    name = "live_sessions" if clean else "live_sessions_raw"
    if keep_late:
        late_job(spark, lake, settings, files_per_batch, name)
    events = stream_landing(spark, lake.landing, files_per_batch)
    if clean:
        ready = live.clean_stream(events, settings.watermark_seconds)
    else:
        ready = live.with_lateness(identified(events), settings.watermark_seconds)
    checkpoint = lake.checkpoint(name, sink)
    if sink == "table":
        sums = live.drain(live.live_session_sums(ready, settings.gap_seconds), name, checkpoint, every=every)
        table = lake.stream_table(f"{name}_numbered")
        writer = sums.foreachBatch(numbered.number_batch(table, f"{table}_counts", spark))
    else:
        sessions = live.live_sessions(ready, settings.gap_seconds, end)
        writer = live.drain(sessions, name, checkpoint, every=every)
        writer = live.to_console(writer) if sink == "console" else live.to_table(writer, lake.stream_table(name))
    query = writer.start()
    if not wait:
        return query
    query.awaitTermination(timeout)
    if query.isActive:
        return query
    dropped = 0 if allow_late or keep_late else live.late_rows(spark, query)
    if dropped:
        raise RuntimeError(
            f"{dropped} rows came after the watermark had passed them; "
            f"raise lateness_seconds above {settings.watermark_seconds} or allow_late"
        )
    return query


def late_job(
    spark: SparkSession, lake: Lake, settings: Settings, files_per_batch: int, name: str
) -> StreamingQuery:
    """Keep the rows that a stream of that name, run next, drops or may drop.

    Reads the landing zone in the same batches; files that land in between are read by its
    next run, against a later mark, so no dropped row is missed. Rows that the stream still
    takes may be among them, which costs a repair and changes nothing.
    """
    events = identified(stream_landing(spark, lake.landing, files_per_batch))
    table = lake.stream_table(f"{name}_late")
    keep = late.keep_late(table, f"{table}_marks", settings.watermark_seconds)
    query = live.drain(events, f"{name}_late", lake.checkpoint(f"{name}_late", "table")).foreachBatch(keep).start()
    query.awaitTermination()
    return query


def repair_job(
    spark: SparkSession, lake: Lake, settings: Settings = Settings(), clean: bool = True
) -> int:
    """The stream's sessions with those of users that had late rows built anew; rows written.

    Sessions of other users are the stream's. Those of users with late rows come from all of
    their events, as far as the stream would have closed them by now. The result is a table
    of its own, which the next repair replaces.
    """
    name = "live_sessions" if clean else "live_sessions_raw"
    table = lake.stream_table(f"{name}_late")
    users = _written(read_table(spark, table).select("user_id").distinct(), "users")
    events = type_events(read_landing(spark, lake.landing)).join(users, "user_id", "left_semi")
    events = drop_repeats(clean_events(events)) if clean else identified(events)
    newest = late.newest_event(spark, f"{table}_marks")
    closed_by = F.date_trunc("millisecond", F.lit(newest)) - F.make_interval(secs=F.lit(settings.watermark_seconds))
    rebuilt = window_sessions(events, settings.gap_seconds).where(F.col("window_end") <= closed_by)
    others = spark.read.parquet(lake.stream_table(name)).join(users, "user_id", "left_anti")
    return write_table(rebuilt.unionByName(others), lake.stream_table(f"{name}_repaired"))
