"""Sessions day by day: what a day adds to the sessions that are already there.

A user's history up to some day fits in one row, the state: how many sessions have begun,
and the last of them as far as it is known. The next days continue from it. The last
session goes in as if it were one more slice of the user's timeline, older than all others,
and the number of sessions so far is added to the running sum that numbers them. So a day
costs its own events and a narrow row per user, whatever came before.

Slices are cut at midnight here, so that the state after every day is known: sessions that
pass midnight have a part for each of their days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitfold.fixed import SESSION_GAP_SECONDS
from visitfold.functions.timeline import gap_ticks, session_id, slice_start, tick
from visitfold.operators.cleaning import identified
from visitfold.operators.sessions import measures, session_rows

SUMS = ["num_events", "num_pageviews", "purchases"]
OPEN_SESSION = ["entry", "exit", *SUMS]
STATE = ["user_id", "event_date", "sessions", *OPEN_SESSION]


def _folded() -> list[Column]:
    return [F.min("entry").alias("entry"), F.max("exit").alias("exit"), *[F.sum(name).alias(name) for name in SUMS]]


def session_progress(
    events: DataFrame, prior: DataFrame | None = None, gap_seconds: int = SESSION_GAP_SECONDS, exact: bool = False
) -> DataFrame:
    """user_id, session_index, event_date and the session as known at the end of that day.

    One row for each day on which a session has events. ``prior`` are states of users before
    the first of the events; their last sessions are rows too, under the day of the state.
    Partial aggregation runs before the only shuffle of events, which spreads a user over
    slices; the rest is by user, one row per slice. ``day_ends`` marks the last row of a user's
    day and ``session_ends`` that of a session, so that ``states`` and ``sessions_of`` are filters.
    """
    at = F.col("event_timestamp")
    slices = (
        identified(events)
        .groupBy("user_id", F.to_date(at).alias("event_date"), slice_start(at, gap_seconds, exact).alias("_slice"))
        .agg(*measures())
        .drop("_slice")
        .withColumn("sessions", F.lit(None).cast("long"))
    )
    if prior is not None:
        slices = slices.select(*STATE).unionByName(prior.select(*STATE))
    first, last = tick(F.col("entry.event_timestamp"), exact), tick(F.col("exit.event_timestamp"), exact)
    slices = slices.withColumn("_first", first).withColumn("_last", last)
    by_time = Window.partitionBy("user_id").orderBy("_first")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = F.col("_first") - F.lag("_last").over(by_time)
    opens = F.coalesce(pause > gap_ticks(gap_seconds, exact), F.lit(True)).cast("long")
    before = F.coalesce(F.first("sessions").over(so_far), F.lit(1).cast("long")) - 1
    numbered = slices.withColumn("_opens", opens).withColumn("_before", before)
    numbered = numbered.withColumn("session_index", F.sum("_opens").over(so_far) + F.col("_before"))
    parts = numbered.groupBy("user_id", "session_index", "event_date").agg(*_folded())
    days = (
        Window.partitionBy("user_id", "session_index")
        .orderBy("event_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    known = [F.min("entry").over(days).alias("entry"), F.max("exit").over(days).alias("exit")]
    known += [F.sum(name).over(days).alias(name) for name in SUMS]
    # sessions of a user follow each other, and so do their days
    onward = Window.partitionBy("user_id").orderBy("session_index", "event_date")
    ends = {
        mark: ~F.coalesce(F.lead(name).over(onward) == F.col(name), F.lit(False))
        for mark, name in (("day_ends", "event_date"), ("session_ends", "session_index"))
    }
    return parts.select(
        "user_id", "session_index", "event_date", *known, *[column.alias(mark) for mark, column in ends.items()]
    )


def states(progress: DataFrame) -> DataFrame:
    """The state of every user after every day with events of theirs: one row per user and day."""
    newest = progress.where("day_ends")
    return newest.select("user_id", "event_date", F.col("session_index").alias("sessions"), *OPEN_SESSION)


def latest_states(rows: DataFrame) -> DataFrame:
    """Of each user the last state."""
    names = [name for name in STATE if name != "user_id"]
    newest = rows.groupBy("user_id").agg(F.max_by(F.struct(*names), "event_date").alias("newest"))
    return newest.select("user_id", *[F.col(f"newest.{name}").alias(name) for name in names])


def sessions_of(progress: DataFrame) -> DataFrame:
    """One row per session, with the columns of ``build_sessions``, as known on its last day."""
    whole = progress.where("session_ends")
    return session_rows(
        whole.select("user_id", *OPEN_SESSION, session_id("user_id", "session_index").alias("session_id"))
    )


def _still_open(day: str, gap_seconds: int) -> Column:
    midnight = F.unix_timestamp(F.lit(day).cast("date").cast("timestamp"))
    return tick(F.col("exit.event_timestamp")) + gap_seconds >= midnight


def open_at(rows: DataFrame, day: str, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """States whose last session an event on ``day`` or later could still continue."""
    return rows.where(_still_open(day, gap_seconds))


def changed_users(
    old: DataFrame, new: DataFrame, day: str, gap_seconds: int = SESSION_GAP_SECONDS
) -> DataFrame:
    """user_id of those whose sessions from ``day`` on differ, by their last states before it.

    Those are users with another number of sessions, or another session that is still open.
    """
    goes_on = F.struct("sessions", F.when(_still_open(day, gap_seconds), F.struct(*OPEN_SESSION)).alias("open"))
    both = old.select("user_id", goes_on.alias("old")).join(
        new.select("user_id", goes_on.alias("new")), "user_id", "full"
    )
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("user_id")
