"""Events that come too late for the stream: kept in a table, and made good by a repair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitfold.sources import manifests
from visitfold.sources.tables import read_table, table_exists, write_table


def keep_late(late: str, marks: str, lateness_seconds: int) -> Callable[[DataFrame, int], None]:
    """What a stream of all events does with every batch: rows behind the mark go to a table.

    The mark is the newest event of earlier batches less the lateness. ``marks`` has the
    newest event of every batch. Rows are added under the batch's name, so a batch that runs
    again changes nothing.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, load = batch.sparkSession, f"batch-{number}"
        manifest = manifests.latest(spark, marks)
        if manifest is not None and load in manifest.loads:
            return
        mark = newest_event(spark, marks, number)
        at = F.col("event_timestamp")
        behind = at <= F.lit(mark) - F.make_interval(secs=F.lit(lateness_seconds)) if mark else F.lit(False)
        rows = batch.where(behind).withColumn("event_date", F.to_date(at))
        write_table(rows, late, ["event_date"], replace="add", load=load)
        newest = batch.agg(F.max(at).alias("newest")).withColumn("batch", F.lit(number).cast("long"))
        write_table(newest, marks, replace="add", load=load)

    return run


def newest_event(spark, marks: str, before: int | None = None):
    """The newest event of all batches, or of those before one; null if there is none."""
    if not table_exists(spark, marks):
        return None
    rows = read_table(spark, marks)
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    return rows.agg(F.max("newest")).first()[0]
