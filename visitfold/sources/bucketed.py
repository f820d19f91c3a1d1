"""Events by user in buckets, for work that is by user again and again.

A bucket is read by one task, so buckets hold users of usual size only. Heavy ones, found by
a sketch, lie in a plain table beside it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.operators.heavy import heavy_counts
from visitfold.sources.tables import read_table, write_table


@dataclass(frozen=True)
class Buckets:
    """A table of the session's catalog below ``path``, and the heavy users' rows beside it."""

    name: str
    path: str
    buckets: int
    key: str = "user_id"
    sort: tuple[str, ...] = ("event_timestamp",)

    @property
    def heavy_path(self) -> str:
        return f"{self.path.rstrip('/')}_heavy"

    def write(self, events: DataFrame) -> None:
        """Replace both tables. One shuffle by user, so that every bucket is one file."""
        heavy = F.broadcast(heavy_counts(events, self.key, self.buckets).select(self.key))
        write_table(events.join(heavy, self.key, "left_semi").select(*events.columns), self.heavy_path)
        others = events.join(heavy, self.key, "left_anti").select(*events.columns)
        (
            others.repartition(self.buckets, self.key)
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key, *self.sort)
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def attach(self, spark: SparkSession, schema: str) -> None:
        """Name files that another session wrote; ``schema`` as DDL."""
        order = ", ".join([self.key, *self.sort])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet "
            f"CLUSTERED BY ({self.key}) SORTED BY ({order}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def usual(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def heavy(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.heavy_path)
