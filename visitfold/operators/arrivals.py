"""New events against those that are stored: nothing is stored twice, and no stored day is shuffled.

For every day a bitmap of its stored keys lies beside the table, a few megabytes whatever
the day holds. A new event whose bits are not all set is surely new. The others, repeats and
a few that look like one, are compared with the stored keys of their days exactly; they are
broadcast to the stored rows if they are few, which is checked. A load that is large itself, next
to what its days hold, is compared with the stored keys at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitfold.fixed import EVENT_KEY
from visitfold.functions.bitmaps import bitmap_bits, bitmap_word

#: Rows that are broadcast at most.
FEW = 200_000
#: Stored rows for a new one, up to which one join of both shuffles less than the bitmaps do.
SHARE = 4
DAY = "event_date"


def day_bitmaps(events: DataFrame, key: list[str] = EVENT_KEY) -> DataFrame:
    """event_date, word and bits of the keys of events. Those of two sets are merged by ``bit_or``."""
    marks = events.select(DAY, bitmap_word(key).alias("word"), bitmap_bits(key).alias("bits"))
    return marks.groupBy(DAY, "word").agg(F.bit_or("bits").alias("bits"))


def maybe_stored(events: DataFrame, bitmaps: DataFrame, key: list[str] = EVENT_KEY) -> DataFrame:
    """Events with ``maybe``: false for those that are surely not among the bitmaps' events."""
    merged = bitmaps.groupBy(DAY, "word").agg(F.bit_or("bits").alias("_set"))
    placed = events.withColumn("word", bitmap_word(key)).withColumn("bits", bitmap_bits(key))
    met = placed.join(merged, [DAY, "word"], "left")
    maybe = F.coalesce(F.col("_set").bitwiseAND(F.col("bits")) == F.col("bits"), F.lit(False))
    return met.select(*events.columns, maybe.alias("maybe"))


def not_stored(
    told: DataFrame, stored: DataFrame, key: list[str] = EVENT_KEY, few: int = FEW
) -> DataFrame:
    """Of the rows of ``maybe_stored``, a written table, those that are new.

    ``stored`` is read in the days of rows that may be repeats, its key columns only.
    """
    maybe = told.where("maybe")
    found = maybe.groupBy(DAY).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each day
    fresh = told.where("NOT maybe")
    if found:
        days = [row[DAY] for row in found]
        old = stored.where(F.col(DAY).isin(days)).select(DAY, *key)
        if sum(row["n"] for row in found) > few:
            return fresh.unionByName(_unlike(maybe, old, key)).drop("maybe")
        keys = F.broadcast(maybe.select(DAY, *key).distinct())
        same = [F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}")) for name in [DAY, *key]]
        repeats = F.broadcast(old.alias("old").join(keys.alias("new"), same, "left_semi").distinct())
        fresh = fresh.unionByName(_unlike(maybe, repeats, key))
    return fresh.drop("maybe")


def _unlike(events: DataFrame, old: DataFrame, key: list[str]) -> DataFrame:
    """Events whose day and key, null or not, are not among the old ones."""
    return events.join(old, [events[name].eqNullSafe(old[name]) for name in [DAY, *key]], "left_anti")


def is_large(events: DataFrame, stored: DataFrame, few: int = FEW, share: int = SHARE) -> bool:
    """Whether a load, a written table, is compared with the stored keys without bitmaps first.

    Rows are counted, which reads no column but the day.
    """
    days = events.groupBy(DAY).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each day
    new = sum(row["n"] for row in days)
    return new > few and stored.where(F.col(DAY).isin([row[DAY] for row in days])).count() <= share * new


def compared(events: DataFrame, stored: DataFrame, key: list[str] = EVENT_KEY) -> DataFrame:
    """Events that are new, by one join with the keys that their days hold."""
    days = [row[DAY] for row in events.select(DAY).distinct().collect()]
    return _unlike(events, stored.where(F.col(DAY).isin(days)).select(DAY, *key), key)
