"""Live sessions with their number and id, in a table by day.

A user's sessions close in order of time, so a closed session's number is that of the ones
before it and one more. Each batch numbers what it closes from the counts of earlier
batches, and adds to two tables under its own name: a batch that runs again after a failure
finds the same counts and adds nothing twice.

A batch is written once before it is counted and numbered: its plan reads the files and the
state store again each time it runs. The job's own session reads it back, as a stream's has no
adaptive execution, without which every task would write a file for each day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitfold.functions.timeline import session_id
from visitfold.operators.sessions import session_rows
from visitfold.sources import manifests
from visitfold.sources.scratch import scratch_dir
from visitfold.sources.tables import read_table, table_exists, write_table

#: Versions of the counts after which they become one.
GATHERED = 50


def counts_before(batch: DataFrame, counts: str, number: int) -> DataFrame | None:
    """user_id and the number of their sessions closed in earlier batches."""
    spark = batch.sparkSession
    if not table_exists(spark, counts):
        return None
    earlier = read_table(spark, counts).where(F.col("batch") < number)
    return earlier.groupBy("user_id").agg(F.max("sessions").alias("sessions"))


def _gather(batch: DataFrame, counts: str, number: int) -> None:
    spark = batch.sparkSession
    manifest = manifests.latest(spark, counts)
    if manifest is not None and len(manifest.versions) > GATHERED and f"batch-{number}" not in manifest.loads:
        newest = counts_before(batch, counts, number)
        write_table(newest.withColumn("batch", F.lit(number - 1).cast("long")), counts)


def _closed(batch: DataFrame, spark: SparkSession) -> DataFrame:
    """A batch as a table in the scratch folder."""
    path = scratch_dir(batch.sparkSession, "closed")
    batch.write.parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def number_batch(
    sessions: str, counts: str, spark: SparkSession | None = None
) -> Callable[[DataFrame, int], None]:
    """What a stream does with every batch of closed sessions, see ``live_session_sums``.

    ``spark`` is the session of the job, the batch's if not given.
    """

    def run(batch: DataFrame, number: int) -> None:
        load = f"batch-{number}"
        manifest = manifests.latest(batch.sparkSession, sessions)
        if manifest is not None and load in manifest.loads:
            return
        closed = _closed(batch, spark or batch.sparkSession)
        _gather(closed, counts, number)
        zero, before = F.lit(0).cast("long"), counts_before(closed, counts, number)

        def after_those_before(rows: DataFrame) -> DataFrame:
            if before is None:
                return rows.withColumn("sessions", zero)
            return rows.join(before, "user_id", "left").withColumn("sessions", F.coalesce("sessions", zero))

        told = after_those_before(closed.groupBy("user_id").agg(F.count(F.lit(1)).alias("_more")))
        told = told.select("user_id", (F.col("sessions") + F.col("_more")).alias("sessions"))
        write_table(told.withColumn("batch", F.lit(number).cast("long")), counts, replace="add", load=load)
        by_time = Window.partitionBy("user_id").orderBy("entry")
        numbered = after_those_before(closed.withColumn("_place", F.row_number().over(by_time).cast("long")))
        numbered = numbered.withColumn("session_index", F.col("sessions") + F.col("_place"))
        rows = session_rows(numbered.withColumn("session_id", session_id("user_id", "session_index")))
        write_table(rows, sessions, ["event_date"], gather=True, replace="add", load=load)

    return run
