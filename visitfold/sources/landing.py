"""The landing zone: gzipped JSON lines in one folder per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitfold.fixed import LANDING_SCHEMA, LANDING_TIME_FORMAT
from visitfold.functions.timeline import event_time
from visitfold.sources.scratch import scratch_dir
from visitfold.sources.tables import read_table, table_days, write_table

CORRUPT = "corrupt_line"
READ_SCHEMA = f"{LANDING_SCHEMA}, {CORRUPT} STRING"

# A gzip file is read by a single task, so its length bounds that task.
ROWS_PER_FILE = 2_000_000


def read_landing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines below ``path``, or of a list of files, as text fields, with their file.

    A line that is no JSON object keeps its text in ``corrupt_line``. Day folders are
    walked but their names are not believed: the day comes from the event time.
    """
    lines = (
        spark.read.schema(READ_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return lines.withColumn("source_file", F.col("_metadata.file_path"))


def stream_landing(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The landing zone as a stream of typed events, a bounded number of files at a time."""
    lines = (
        spark.readStream.schema(LANDING_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return lines.withColumn("event_timestamp", event_time("event_timestamp"))


def type_events(lines: DataFrame) -> DataFrame:
    """Typed events: a real event time, its day and when they were loaded. Drops nothing."""
    return (
        lines.withColumn("event_timestamp", event_time("event_timestamp"))
        .withColumn("event_date", F.to_date("event_timestamp"))
        .withColumn("ingest_ts", F.current_timestamp())
    )


def landing_lines(events: DataFrame) -> DataFrame:
    """Events as the landing zone stores them: every field text, plus the day folder.

    The JSON writer cuts times to milliseconds, so they are turned into text first.
    Text times stay as they are, readable or not.
    """
    at = F.col("event_timestamp")
    if isinstance(events.schema["event_timestamp"].dataType, T.StringType):
        text, day = at, F.to_date(event_time("event_timestamp"))
    else:
        text, day = F.date_format(at, LANDING_TIME_FORMAT), F.to_date(at)
    texts = {name: F.col(name).cast("string") for name in T.StructType.fromDDL(LANDING_SCHEMA).names}
    texts["event_timestamp"] = text
    fields = [column.alias(name) for name, column in texts.items()]
    return events.select(*fields, day.alias("event_date"))


def _write_lines(lines: DataFrame, path: str, mode: str) -> None:
    (
        lines.hint("rebalance", F.col("event_date"))
        .write.mode(mode)
        .partitionBy("event_date")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .json(path)
    )


def write_landing(events: DataFrame, path: str, days_at_once: int | None = None) -> None:
    """Events as files of the landing zone, which are replaced.

    Tasks write days in any order, and the more tasks the less the files' modification times
    follow the events'. With ``days_at_once`` a job writes that many days and the next job the
    days after them; rows without a day come first. A stream with a lateness of twice as many
    days then drops no row, whatever its batches.
    """
    lines = landing_lines(events)
    if days_at_once is None:
        _write_lines(lines, path, "overwrite")
        return
    spark = events.sparkSession
    staged = scratch_dir(spark, "lines")
    write_table(lines, staged, ["event_date"], gather=True)
    _write_lines(read_table(spark, staged).where("event_date IS NULL"), path, "overwrite")
    for since, until in day_spans(table_days(spark, staged), days_at_once):
        _write_lines(read_table(spark, staged, since, until), path, "append")


def day_spans(days: list[str], length: int) -> list[tuple[str, str]]:
    """First and last day of spans of at most ``length`` days, in order, that hold all of some days."""
    spans: list[tuple[str, str]] = []
    for day in sorted(days):
        if spans and (date.fromisoformat(day) - date.fromisoformat(spans[-1][0])).days < length:
            spans[-1] = (spans[-1][0], day)
        else:
            spans.append((day, day))
    return spans


def rows_per_day(events: DataFrame) -> DataFrame:
    """How many events the landing zone holds for each day."""
    return landing_lines(events).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))
