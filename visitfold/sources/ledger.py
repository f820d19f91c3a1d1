"""The ledger of landing files: what each holds and by which load it came in.

A load reads the files that no load has read; a day range reads those that overlap it. The
ledger is written first and the rows after it, under the same load name. A file counts as
read once the rows' manifest names its load, so a load that is killed in between is simply
run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.sources import manifests
from visitfold.sources.tables import read_table, table_exists, write_table

COLUMNS = (
    "source_file STRING, path STRING, bytes LONG, modified TIMESTAMP, lines LONG, "
    "first_time TIMESTAMP, last_time TIMESTAMP, load STRING"
)
NAMES = [column.split()[0] for column in COLUMNS.split(", ")]
SEEN = ["source_file", "bytes", "modified"]
#: Size of a file that is not there any more.
GONE = -1


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """source_file, path, bytes and modified of every file below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("source_file"),
        "path",
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def known_files(spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """Of each file that ``table`` has rows of, what its last load found."""
    manifest = manifests.latest(spark, table)
    if manifest is None or not manifest.loads or not table_exists(spark, ledger):
        return spark.createDataFrame([], COLUMNS)
    loads = spark.createDataFrame(list(enumerate(manifest.loads)), "place INT, load STRING")
    last = F.max_by(F.struct(*NAMES), "place").alias("last")
    rows = read_table(spark, ledger).join(F.broadcast(loads), "load").groupBy("source_file").agg(last)
    return rows.select("last.*").where(F.col("bytes") != GONE)


def new_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Files that no load has read as they are now; one that has changed since is new again."""
    return listed.join(known.select(*SEEN), SEEN, "left_anti")


def altered_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Ledger rows of files that are gone or have changed since they were read."""
    return known.join(listed.select(*SEEN), SEEN, "left_anti")


def overlapping(known: DataFrame, since: str, until: str) -> DataFrame:
    """Files that have an event on a day from ``since`` up to and including ``until``."""
    return known.where(
        (F.to_date("last_time") >= F.lit(since).cast("date")) & (F.to_date("first_time") <= F.lit(until).cast("date"))
    )


def paths_of(files: DataFrame) -> list[str]:
    """File names for a reader, which takes them from the driver; as many as a load has files."""
    return [row[0] for row in files.select("path").orderBy("path").collect()]


def describe(files: DataFrame, events: DataFrame, load: str) -> DataFrame:
    """Ledger rows of the files of a load, from its typed events. Files without lines have none."""
    held = events.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("event_timestamp").alias("first_time"),
        F.max("event_timestamp").alias("last_time"),
    )
    lines = F.coalesce("lines", F.lit(0).cast("long")).alias("lines")
    return files.join(held, "source_file", "left").select(
        *("source_file", "path", "bytes", "modified"), lines, "first_time", "last_time", F.lit(load).alias("load")
    )


def tombstones(files: DataFrame, load: str) -> DataFrame:
    """Ledger rows that say that files are gone."""
    gone = {"bytes": F.lit(GONE).cast("long"), "lines": F.lit(0).cast("long"), "load": F.lit(load)}
    return files.withColumns(gone).select(*NAMES)
