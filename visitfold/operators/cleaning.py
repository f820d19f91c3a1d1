"""Cleaning steps shared by the batch job and the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitfold.fixed import EVENT_KEY
from visitfold.functions.text import is_bot, lower_code, upper_code


def identified(events: DataFrame) -> DataFrame:
    """Events that can be placed on a timeline: they have a user and a time.

    Plain null tests, unlike ``dropna``, are pushed down to the Parquet scan.
    """
    return events.where(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())


def usable(events: DataFrame) -> DataFrame:
    """Events that have a user, a time and a type. Blank text counts as present."""
    return identified(events).where(F.col("event_type").isNotNull())


def tag_bots(events: DataFrame) -> DataFrame:
    return events.withColumn("is_bot", is_bot())


def normalise(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "event_type": lower_code("event_type"),
            "device": lower_code("device"),
            "country": upper_code("country"),
        }
    )


def clean_events(events: DataFrame) -> DataFrame:
    """Usable events of people, with normalised codes. Map-only; works on streams."""
    return normalise(usable(events).where(~is_bot()))


def drop_repeats(
    events: DataFrame, key: list[str] | None = None, prefer: list[Column] | None = None
) -> DataFrame:
    """One row per business key.

    Copies are first dropped inside each input task, so a key whose copies fill a
    third of the table sends one row per task. Which copy stays is open unless
    ``prefer`` orders them.
    """
    key = key or EVENT_KEY
    if not prefer:
        return events.dropDuplicates(key)
    copies = Window.partitionBy(*key).orderBy(*prefer)
    return (
        events.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")
    )
