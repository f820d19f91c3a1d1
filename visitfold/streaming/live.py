"""Live sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from visitfold.fixed import EVENT_KEY, SESSION_GAP_SECONDS
from visitfold.functions.timeline import seconds_between
from visitfold.operators.cleaning import clean_events
from visitfold.operators.sessions import measures


# How many batches' progress a query remembers.
RETAINED = "spark.sql.streaming.numRecentProgressUpdates"


def with_lateness(events: DataFrame, watermark_seconds: int) -> DataFrame:
    return events.withWatermark("event_timestamp", f"{watermark_seconds} seconds")


def clean_stream(events: DataFrame, watermark_seconds: int = 2 * SESSION_GAP_SECONDS) -> DataFrame:
    """The batch cleaning on a stream; copies are dropped while the watermark holds them."""
    return with_lateness(clean_events(events), watermark_seconds).dropDuplicatesWithinWatermark(
        EVENT_KEY
    )


def live_sessions(
    events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, end: str = "last_event"
) -> DataFrame:
    """Sessions of a stream that carries a watermark.

    ``end="last_event"`` gives the times of the batch table and the closing time of
    the window as ``window_end``. ``end="window"`` reports the window's own end, one
    gap after the last event, as ``end_ts``. An index per user does not exist while
    earlier events may still come, so sessions carry no id.
    """
    at = F.col("event_timestamp")
    grouped = events.groupBy("user_id", F.session_window(at, f"{gap_seconds} seconds")).agg(
        F.max(at).alias("last_ts"),
        F.count(F.lit(1)).alias("num_events"),
        F.count_if(F.col("event_type") == "page_view").alias("num_pageviews"),
        (F.count_if(F.col("event_type") == "purchase") > 0).alias("converted"),
    )
    closing = "last_ts" if end == "last_event" else "session_window.end"
    columns = [
        "user_id",
        F.col("session_window.start").alias("start_ts"),
        F.col(closing).alias("end_ts"),
        seconds_between("session_window.start", closing).alias("duration_sec"),
        "num_events",
        "num_pageviews",
        "converted",
    ]
    if end == "last_event":
        columns.append(F.col("session_window.end").alias("window_end"))
    return grouped.select(*columns)


def live_session_sums(events: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Closed sessions with the sums from which all columns of a session follow."""
    window = F.session_window("event_timestamp", f"{gap_seconds} seconds")
    grouped = events.groupBy("user_id", window).agg(*measures())
    return grouped.select("user_id", *SUMS, F.col("session_window.end").alias("window_end"))


#: Columns of ``live_session_sums``, in the order in which the state store holds them.
SUMS = ["entry", "exit", "num_events", "num_pageviews", "purchases"]


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Sessions that a stopped stream of ``live_session_sums`` still holds, as it would close them.

    Read from the state store of the stream's last batch. The store has the grouping columns,
    the window, and then the sums in the order in which they are stated.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    number = operators.where("operatorName LIKE 'sessionWindow%'").first()["operatorId"]
    held = spark.read.format("statestore").option("operatorId", number).load(checkpoint)
    fields = [field.dataType.simpleString() for field in held.schema["value"].dataType.fields]
    names = ["user_id", "session_window", *SUMS]
    value = F.col("value").cast(f"struct<{','.join(map(':'.join, zip(names, fields, strict=True)))}>")
    return held.select(value.alias("value")).select(
        *[f"value.{name}" for name in ["user_id", *SUMS]], F.col("value.session_window.end").alias("window_end")
    )


def drain(
    rows: DataFrame, name: str, checkpoint: str, output_mode: str = "append", every: str | None = None
) -> DataStreamWriter:
    """Writer of a named query that stops once the input present at its start is read.

    With ``every``, a time like "1 minute", it goes on at that pace until it is stopped.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.queryName(name)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


def to_table(writer: DataStreamWriter, path: str) -> DataStreamWriter:
    return writer.format("parquet").option("path", path)


def to_console(writer: DataStreamWriter, shown: int = 20) -> DataStreamWriter:
    """Print each batch in full width."""
    return writer.format("console").option("truncate", False).option("numRows", shown)


def late_rows(spark: SparkSession, query: StreamingQuery) -> int:
    """Rows that an ended run of a query dropped behind its watermark, over all its batches."""
    batches, kept = query.recentProgress, int(spark.conf.get(RETAINED))
    if len(batches) >= kept:
        raise RuntimeError(f"more than {kept} batches: raise {RETAINED} to see all of them")
    return sum(
        operator["numRowsDroppedByWatermark"] for batch in batches for operator in batch["stateOperators"]
    )
