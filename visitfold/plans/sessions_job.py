"""The sessions layer: whole, or from some day on."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.functions.timeline import session_id, tick
from visitfold.lake import Lake, Settings
from visitfold.operators import daily
from visitfold.sources.scratch import scratch_dir
from visitfold.sources.tables import drop_days, read_table, table_days, table_exists, write_table

DAYS = ["event_date"]


def _kept(rows: DataFrame, label: str) -> DataFrame:
    """Rows that are used more than once, as a table in the scratch folder."""
    path = scratch_dir(rows.sparkSession, label)
    write_table(rows, path)
    return read_table(rows.sparkSession, path)


def _shifted(day: str | date, by: int) -> str:
    return str(date.fromisoformat(str(day)) + timedelta(days=by))


def _distinct_days(rows: DataFrame) -> list[str]:
    """Days in a table; their number is bounded by the calendar."""
    return sorted(str(row[0]) for row in rows.select("event_date").distinct().collect() if row[0])


def states_before(spark: SparkSession, lake: Lake, day: str | date) -> DataFrame:
    """The last state of every user before a day: the newest snapshot, and the days since."""
    until = _shifted(day, -1)
    taken = [found for found in table_days(spark, lake.session_snapshots) if found <= until]
    if not taken:
        return daily.latest_states(read_table(spark, lake.session_states, until=until))
    snapshot = read_table(spark, lake.session_snapshots, taken[-1], taken[-1])
    since = snapshot.drop("event_date").withColumnRenamed("last_date", "event_date").select(*daily.STATE)
    later = read_table(spark, lake.session_states, _shifted(taken[-1], 1), until)
    return daily.latest_states(since.unionByName(later.select(*daily.STATE)))


def snapshot_job(spark: SparkSession, lake: Lake, day: str | date) -> int:
    """Store the state of every user at the end of a day, so that later runs read no older one."""
    states = states_before(spark, lake, _shifted(day, 1)).withColumnRenamed("event_date", "last_date")
    rows = states.withColumn("event_date", F.lit(str(day)).cast("date"))
    return write_table(rows, lake.session_snapshots, DAYS, replace="days")


def sessions_job(
    spark: SparkSession,
    lake: Lake,
    settings: Settings = Settings(),
    since: str | date | None = None,
    until: str | date | None = None,
) -> int:
    """Sessions of all of silver, or of the days that a load or a repair has changed.

    With ``since`` the job reads the states before that day and silver from there on, and
    leaves earlier days alone but for sessions that were open at midnight. With ``until``
    it also stops there: of later days only those users are read again, and only those days
    written again, whose state at the end of ``until`` has become another one. The sessions
    are those of a full build. Returns the rows written.
    """
    if since is None or not table_exists(spark, lake.session_states):
        return _all_sessions(spark, lake, settings)
    return _changed_days(spark, lake, settings, str(since), None if until is None else str(until))


def _all_sessions(spark: SparkSession, lake: Lake, settings: Settings) -> int:
    events = read_table(spark, lake.silver)
    progress = _kept(daily.session_progress(events, gap_seconds=settings.gap_seconds), "progress")
    write_table(daily.states(progress), lake.session_states, DAYS, gather=True)
    drop_days(spark, lake.session_snapshots)
    return write_table(
        daily.sessions_of(progress), lake.sessions, list(settings.partition_by), gather=True
    )


def _known_from(progress: DataFrame, day: str, gap_seconds: int) -> DataFrame:
    """Sessions that have events on the day or later, or could still have had."""
    midnight = F.unix_timestamp(F.lit(day).cast("date").cast("timestamp"))
    return daily.sessions_of(progress).where(tick(F.col("end_ts")) + gap_seconds >= midnight)


def _open_ids(states: DataFrame, day: str, gap_seconds: int) -> DataFrame:
    """session_id, user_id and start day of sessions that are open when the day begins."""
    return daily.open_at(states, day, gap_seconds).select(
        session_id("user_id", "sessions").alias("session_id"),
        "user_id",
        F.to_date("entry.event_timestamp").alias("event_date"),
    )


def _stored(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    rows = read_table(spark, path, days[0], days[-1]) if days else read_table(spark, path).limit(0)
    return rows.where(F.col("event_date").isin([date.fromisoformat(day) for day in days]))


def _changed_days(spark: SparkSession, lake: Lake, settings: Settings, since: str, until: str | None) -> int:
    gap = settings.gap_seconds
    prior = _kept(states_before(spark, lake, since), "prior")
    events = read_table(spark, lake.silver, since, until)
    progress = _kept(daily.session_progress(events, prior, gap), "progress")
    fresh = _known_from(progress, since, gap)
    states = daily.states(progress.where(F.col("event_date") >= F.lit(since).cast("date")))
    # sessions that pass the first midnight begin on earlier days, which are written again
    early = _kept(_open_ids(prior, since, gap), "open")
    early_days = _distinct_days(early)
    known = set(table_days(spark, lake.silver)) | set(table_days(spark, lake.sessions))
    later_days: list[str] = []
    if until is not None and max(known, default=until) > until:
        fresh, states, later_days = _with_later_days(spark, lake, gap, until, prior, fresh, states)
    rows = fresh.unionByName(_stored(spark, lake.sessions, early_days).join(early, "session_id", "left_anti"))
    written = write_table(
        rows,
        lake.sessions,
        list(settings.partition_by),
        gather=True,
        replace="days",
        span=(since, until),
        days=later_days,
    )
    write_table(states, lake.session_states, DAYS, gather=True, replace="days", span=(since, until), days=later_days)
    drop_days(spark, lake.session_snapshots, since)
    return written


def _with_later_days(
    spark: SparkSession, lake: Lake, gap: int, until: str, prior: DataFrame, fresh: DataFrame, states: DataFrame
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Sessions and states completed by the days after ``until``, and which of these change."""
    onward = _shifted(until, 1)
    states = _kept(states, "states")
    after = _kept(daily.latest_states(prior.select(*daily.STATE).unionByName(states)), "after")
    users = _kept(daily.changed_users(states_before(spark, lake, onward), after, onward, gap), "changed")
    events = read_table(spark, lake.silver, onward).join(users, "user_id", "left_semi")
    tail = daily.session_progress(events, after.join(users, "user_id", "left_semi"), gap)
    tail = _kept(tail, "tail")
    tail_states = daily.states(tail.where(F.col("event_date") >= F.lit(onward).cast("date")))
    # a session that is open at the end goes on in the tail if its user has changed, and else
    # is the one that is stored
    open_last = _kept(_open_ids(after, onward, gap), "open")
    continued = _stored(spark, lake.sessions, _distinct_days(open_last))
    unchanged = open_last.join(users, "user_id", "left_anti").select("session_id")
    fresh = (
        fresh.join(open_last, "session_id", "left_anti")
        .unionByName(continued.join(unchanged, "session_id", "left_semi"))
        .unionByName(_known_from(tail, onward, gap))
    )
    stored, stored_states = read_table(spark, lake.sessions, onward), read_table(spark, lake.session_states, onward)
    changed = stored.join(users, "user_id", "left_semi").select("event_date")
    changed = changed.union(stored_states.join(users, "user_id", "left_semi").select("event_date"))
    days = _distinct_days(changed.union(tail_states.select("event_date")))
    days = [day for day in days if day >= onward]
    others = _stored(spark, lake.sessions, days).join(users, "user_id", "left_anti")
    other_states = _stored(spark, lake.session_states, days).join(users, "user_id", "left_anti")
    return (
        fresh.unionByName(others),
        states.unionByName(tail_states).unionByName(other_states.select(*states.columns)),
        days,
    )
