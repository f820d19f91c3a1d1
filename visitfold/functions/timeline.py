"""Expressions that place events on a user's timeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def event_time(text: str) -> Column:
    """Event time from its text; text that is no time gives null instead of an error."""
    return F.try_to_timestamp(F.col(text))


def tick(ts: Column, exact: bool = False) -> Column:
    """Position on the timeline: whole seconds (floored), or microseconds if exact."""
    return F.unix_micros(ts.cast("timestamp")) if exact else F.unix_timestamp(ts)


def gap_ticks(gap_seconds: int, exact: bool = False) -> int:
    return gap_seconds * MICROS if exact else gap_seconds


def slice_start(ts: Column, gap_seconds: int, exact: bool = False) -> Column:
    """First tick of the time slice that holds ``ts``.

    A slice is ``gap + 1`` ticks wide: its first and last tick lie exactly one gap
    apart, so two events of one user in the same slice are never in different
    sessions. ``pmod`` keeps this true before 1970 as well.
    """
    at = tick(ts, exact)
    return at - F.pmod(at, F.lit(gap_ticks(gap_seconds, exact) + 1))


def seconds_between(start: str, end: str) -> Column:
    return F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))


def session_id(user: str, index: str) -> Column:
    """Id of a user's n-th session, stable for a given set of events."""
    return F.sha2(F.concat_ws("|", F.col(user).cast("string"), F.col(index).cast("string")), 256)
