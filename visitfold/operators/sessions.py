"""Sessions: runs of one user's events with no pause longer than the gap.

A user can own a third of all events, so no step may gather a user's events. The
timeline is cut into slices no wider than the gap (``slice_start``). Events of one
user in one slice always share a session, which makes the slice the unit:

1. aggregate events by user and slice; partial aggregation runs before the shuffle
   and the shuffle spreads a user over all their slices,
2. number sessions by a window over a user's *slices*. Their count is bounded by
   elapsed time over gap (17,520 for a year of half hours), not by events,
3. fold slices into sessions, or join the number back to the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitfold.fixed import SESSION_GAP_SECONDS
from visitfold.functions.timeline import (
    MICROS,
    gap_ticks,
    seconds_between,
    session_id,
    slice_start,
    tick,
)
from visitfold.operators.cleaning import identified


def number_slices(slices: DataFrame, gap: int, first_tick: Column, last_tick: Column) -> DataFrame:
    """Add ``session_index`` (1, 2, ...) to rows that are one user's slices."""
    by_time = Window.partitionBy("user_id").orderBy("_slice")
    pause = first_tick - F.lag(last_tick).over(by_time)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slices.withColumn("_opens", F.coalesce(pause > gap, F.lit(True)).cast("int")).withColumn(
        "session_index", F.sum("_opens").over(so_far)
    ).drop("_opens")


def tag_sessions(
    events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, exact: bool = False
) -> DataFrame:
    """Events with ``session_index`` and ``session_id``.

    The numbering pass reads only user and time. Its result has one row per user and
    slice, so the join back neither drops nor repeats events; where a single slice is
    hot, adaptive execution splits the event side of the join. The numbers are hashed
    and not sorted against the much wider events: their partitions are even, as keys are
    unique, and have a few narrow columns. Events without user
    or time belong to no session and get nulls. Only the index goes through the join;
    ids, eight times as wide, are hashed after it.
    """
    at = F.col("event_timestamp")
    slices = (
        identified(events)
        .groupBy("user_id", slice_start(at, gap_seconds, exact).alias("_slice"))
        .agg(
            F.min(tick(at, exact)).alias("first_tick"),
            F.max(tick(at, exact)).alias("last_tick"),
        )
    )
    numbered = number_slices(
        slices, gap_ticks(gap_seconds, exact), F.col("first_tick"), F.col("last_tick")
    ).select("user_id", "_slice", "session_index").hint("shuffle_hash")
    number = F.when(
        F.col("session_index").isNotNull(), session_id("user_id", "session_index")
    )
    return (
        events.withColumn("_slice", slice_start(at, gap_seconds, exact))
        .join(numbered, ["user_id", "_slice"], "left")
        .select(*events.columns, "session_index", number.alias("session_id"))
    )


def measures() -> list[Column]:
    """What is summed up of events before sessions are known."""
    place = F.struct("event_timestamp", "path")
    return [
        F.min(place).alias("entry"),
        F.max(place).alias("exit"),
        F.count(F.lit(1)).alias("num_events"),
        F.count_if(F.col("event_type") == "page_view").alias("num_pageviews"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    ]


def session_rows(measured: DataFrame) -> DataFrame:
    """The columns of a session from its sums, user and id."""
    return measured.select(
        "session_id",
        "user_id",
        F.col("entry.event_timestamp").alias("start_ts"),
        F.col("exit.event_timestamp").alias("end_ts"),
        "num_events",
        "num_pageviews",
        (F.col("purchases") > 0).alias("converted"),
        F.col("entry.path").alias("entry_path"),
        F.col("exit.path").alias("exit_path"),
        seconds_between("entry.event_timestamp", "exit.event_timestamp").alias("duration_sec"),
        (F.col("num_events") == 1).alias("bounce"),
        F.to_date("entry.event_timestamp").alias("event_date"),
    )


def build_sessions(
    events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, exact: bool = False
) -> DataFrame:
    """One row per session.

    ``exact`` compares microseconds; otherwise pauses are whole seconds. Entry and
    exit path belong to the smallest and largest (time, path) of the session.
    """
    start = slice_start(F.col("event_timestamp"), gap_seconds, exact)
    slices = identified(events).groupBy("user_id", start.alias("_slice")).agg(*measures())
    numbered = number_slices(
        slices,
        gap_ticks(gap_seconds, exact),
        tick(F.col("entry.event_timestamp"), exact),
        tick(F.col("exit.event_timestamp"), exact),
    )
    folded = numbered.groupBy("user_id", "session_index").agg(
        F.min("entry").alias("entry"),
        F.max("exit").alias("exit"),
        F.sum("num_events").alias("num_events"),
        F.sum("num_pageviews").alias("num_pageviews"),
        F.sum("purchases").alias("purchases"),
    )
    return session_rows(
        folded.withColumn("session_id", session_id("user_id", "session_index"))
    )


def fold_tagged(tagged: DataFrame) -> DataFrame:
    """The same rows from events that already carry their session."""
    placed = tagged.where(F.col("session_id").isNotNull())
    return session_rows(placed.groupBy("session_id", "user_id").agg(*measures()))


def window_sessions(events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Sessions by Spark's ``session_window``, as the stream reports them.

    The window takes slices instead of events: each opens at its first event and
    stays open until one gap after its last. So one user's events are not gathered.

    Times of a session come from its rows and not from the window: Spark takes a filter on
    the window to the slices, before they are merged, and so would cut sessions.
    """
    at = F.col("event_timestamp")
    slices = (
        identified(events)
        .groupBy("user_id", slice_start(at, gap_seconds, exact=True).alias("_slice"))
        .agg(
            F.min(at).alias("first_ts"),
            F.max(at).alias("last_ts"),
            F.count(F.lit(1)).alias("num_events"),
            F.count_if(F.col("event_type") == "page_view").alias("num_pageviews"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        )
    )
    span = tick(F.col("last_ts"), exact=True) - tick(F.col("first_ts"), exact=True)
    open_for = F.make_interval(
        secs=F.lit(gap_seconds) + span.cast("decimal(18, 0)") / F.lit(MICROS)
    )
    return (
        slices.groupBy("user_id", F.session_window("first_ts", open_for))
        .agg(
            F.min("first_ts").alias("start_ts"),
            F.max("last_ts").alias("end_ts"),
            F.sum("num_events").alias("num_events"),
            F.sum("num_pageviews").alias("num_pageviews"),
            (F.sum("purchases") > 0).alias("converted"),
        )
        .select(
            "user_id",
            "start_ts",
            "end_ts",
            seconds_between("start_ts", "end_ts").alias("duration_sec"),
            "num_events",
            "num_pageviews",
            "converted",
            (F.col("end_ts") + F.make_interval(secs=F.lit(gap_seconds))).alias("window_end"),
        )
    )
