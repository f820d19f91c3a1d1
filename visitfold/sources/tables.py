"""Parquet tables that are replaced whole or not at all."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitfold.sources import manifests


def _text(day: str | date | None) -> str | None:
    return None if day is None else str(day)


def read_table(
    spark: SparkSession, path: str, since: str | date | None = None, until: str | date | None = None
) -> DataFrame:
    """A table, or only its days from ``since`` up to and including ``until``.

    Days are chosen from the manifest, and the bounds filter the partition column, so
    folders of other days are not listed. A plain Parquet folder is read as it is.
    """
    manifest = manifests.latest(spark, path)
    if manifest is None:
        return between_days(spark.read.parquet(path), since, until)
    rows = manifests.read(spark, path, manifest, _text(since), _text(until))
    return between_days(rows, since, until)


def table_days(spark: SparkSession, path: str) -> list[str]:
    """The days that a table has partitions of."""
    manifest = manifests.latest(spark, path)
    found = () if manifest is None else map(manifests.day_of, manifest.places)
    return sorted({day for day in found if day} - {manifests.NO_DAY})


def table_exists(spark: SparkSession, path: str) -> bool:
    return manifests.latest(spark, path) is not None


def between_days(
    rows: DataFrame, since: str | date | None = None, until: str | date | None = None
) -> DataFrame:
    if since is not None:
        rows = rows.where(F.col("event_date") >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(F.col("event_date") <= F.lit(until).cast("date"))
    return rows


def gather_days(rows: DataFrame, partition_by: list[str]) -> DataFrame:
    """Bring the rows of a day together before a partitioned write.

    After a shuffle on another key every task holds every day and would write one
    file for each. The rebalance hint lets adaptive execution cut a heavy day into
    several even files and join light ones, so no task has to hold a whole day.
    """
    return rows.hint("rebalance", *[F.col(name) for name in partition_by])


@dataclass(frozen=True)
class Staged:
    """A version that is written and not yet part of its table."""

    spark: SparkSession
    path: str
    version: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    count: int

    def rows(self) -> DataFrame:
        return manifests.read(self.spark, self.path, self._manifest(None, {}, False, None))

    def days(self) -> list[str]:
        places = self._manifest(None, {}, False, None).places
        return sorted({day for place in places if (day := manifests.day_of(place))})

    def _manifest(self, before, keep, add, load) -> manifests.Manifest:
        return manifests.successor(
            self.spark, self.path, before, self.version, self.schema, self.partition_by, keep, add, load
        )

    def publish(
        self,
        replace: str = "table",
        span: tuple[str | date | None, str | date | None] | None = None,
        days: Collection[str] = (),
        load: str | None = None,
    ) -> int:
        """Make the version part of its table, see ``write_table``; returns its rows."""
        before = manifests.latest(self.spark, self.path)
        if load is not None and before is not None and load in before.loads:
            return 0
        keep: dict[str, tuple[str, ...]] = {}
        if replace != "table" and before is not None:
            keep = dict(before.places)
            if span is not None:
                keep = manifests.without(before, *map(_text, span))
            keep = {place: found for place, found in keep.items() if manifests.day_of(place) not in days}
        elif before is not None:
            before = manifests.unloaded(before)
        manifests.commit(self.spark, self.path, self._manifest(before, keep, replace == "add", load))
        return self.count


def stage_table(
    rows: DataFrame, path: str, partition_by: list[str] | None = None, gather: bool = False
) -> Staged:
    """Write a new version of a table without making it part of it.

    The count is observed while the rows pass to the writer; nothing is cached or read back.
    """
    names = list(partition_by or ())
    version = manifests.new_version()
    if names and gather:
        rows = gather_days(rows, names)
    written = Observation()
    writer = rows.observe(written, F.count(F.lit(1)).alias("rows")).write
    if names:
        writer = writer.partitionBy(*names)
    writer.parquet(f"{path.rstrip('/')}/{version}")
    return Staged(rows.sparkSession, path, version, rows.schema, tuple(names), written.get["rows"])


def write_table(
    rows: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    gather: bool = False,
    replace: str = "table",
    span: tuple[str | date | None, str | date | None] | None = None,
    days: Collection[str] = (),
    load: str | None = None,
) -> int:
    """Write a new version of a table, then name it in the manifest; returns the rows written.

    ``replace="table"`` replaces everything; ``"days"`` the partitions that get rows and
    those of ``days`` and of the days of ``span``, also where they get none; ``"add"`` only
    the latter. A ``load`` names what is written: what has been written under that name once
    is not written again (and counts as no rows), so a repeated batch changes nothing.
    Readers see the old table until the new one is whole.
    """
    before = manifests.latest(rows.sparkSession, path) if load is not None else None
    if before is not None and load in before.loads:
        return 0
    return stage_table(rows, path, partition_by, gather).publish(replace, span, days, load)


def drop_days(
    spark: SparkSession, path: str, since: str | date | None = None, until: str | date | None = None
) -> None:
    """Take days out of a table; a table that is not there stays so. Nothing is rewritten."""
    before = manifests.latest(spark, path)
    if before is not None:
        left = manifests.without(before, _text(since), _text(until))
        if len(left) < len(before.places):
            manifests.commit(spark, path, manifests.renumbered(before, places=left))
