"""Helpers that the operators share: scratch tables, Arrow passes, words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.sources.scratch import scratch_dir

# Fixed value: what separates words. ``bytes.split`` and ``bytes.lower`` of Python use
# exactly these six characters and A-Z, so tasks that work on UTF-8 need no pattern.
WORD = r"[^\x20\x09-\x0D]+"


# Batches for Python hold few rows, as texts may be long.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "1000"
# Spark settings while a table is written: an execution's shuffle files go when it has ended.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    _BATCH: BATCH_ROWS,
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with small batches for Python; for programs that return lazy results."""
    spark.conf.set(_BATCH, BATCH_ROWS)
    return spark


#: Rows of the bitmap of ``sifted``, 64 bits each: 16 MB at most.
BITMAP_ROWS = 1 << 20
#: Files of the bitmap. It is small, and each file that a task writes costs processes of their own on
#: a local disk (Hadoop starts chmod for it).
BITMAP_FILES = 4


def sifted(rows: DataFrame, wanted: DataFrame, on: list[str], bitmap_rows: int = BITMAP_ROWS) -> DataFrame:
    """Rows that may have a partner in ``wanted``, for a join that follows and drops the rest.

    Told by a bitmap of bounded size, which is broadcast, so that long texts without a
    partner are not shuffled. Four bits of one of its words of 64 are set for every wanted
    key; the more keys, the more other rows pass by chance, up to all.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(bitmap_rows)).alias("_row")
    code = F.xxhash64(*on, F.lit(1))
    bits = F.lit(0).cast("long")
    for k in range(4):
        at = F.shiftright(code, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    bitmap = wanted.select(place, bits.alias("_bits")).groupBy("_row").agg(F.bit_or("_bits").alias("_bits"))
    bitmap = settle(bitmap.repartition(BITMAP_FILES), "bitmap")
    marked = rows.withColumn("_row", place).join(F.broadcast(bitmap), "_row")
    return marked.where(F.col("_bits").bitwiseAND(bits) == bits).select(*rows.columns)


def settle(rows: DataFrame, label: str) -> DataFrame:
    """Write rows below the cluster's shared folder and read them back.

    Cuts lineage, and what is read twice is the same both times, also when an
    executor is lost in between. The shuffles behind the rows are not needed again, so
    their files go as soon as the table is written.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, label)
    before = {name: spark.conf.get(name) for name in _WRITING}
    try:
        for name, value in _WRITING.items():
            spark.conf.set(name, value)
        rows.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    table = spark.read.schema(rows.schema).parquet(path)
    table.settled_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``settle`` wrote, once nothing is read from them any more."""
    for table in tables:
        path = getattr(table, "settled_at", None)
        if path:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def utf8(text: str | Column) -> Column:
    """Text as UTF-8 bytes; null is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("binary"), F.lit(b""))


def boxed(rows: DataFrame) -> Column:
    """All columns of a table as one column, so that added names cannot clash."""
    return F.struct(*[rows[f"`{name}`"] for name in rows.columns])


def carried(rows: DataFrame, columns: list[str] | None, text: str, least: str | None = None) -> Column:
    """The columns that go along through Python as one: those given, or all but the text."""
    names = columns or [name for name in rows.columns if name != text] or [least or text]
    return F.struct(*[rows[f"`{name}`"] for name in names])


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Start of each run, and the end of the last one."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
