"""Keys that hold a large part of the rows, without a count of all keys.

A frequent-items sketch of bounded size goes over the key column: it keeps a limited number
of counters, every one of which is too low or too high by a known part of all rows at most.
Sketches of tasks are merged in two steps. What the sketch proposes is counted exactly in a
second pass, so the answer is exact and complete; only proposed keys are shuffled, one row
for each task and key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitfold.fixed import TOP_KEYS
from visitfold.sources.scratch import scratch_dir
from visitfold.sources.tables import read_table, write_table

# A key is spread if it holds more than one part's share of the rows. Fewer than this many
# keys can do so, whatever the data. A multiple of the shuffle partitions is a good value.
SPREAD_PARTS = 1000

#: Counters of the sketch for each part. It errs by at most 3.5 rows in as many as it has
#: places, four for three counters; a key is proposed if it holds more than twice that.
COUNTERS = 8
#: Keys that are counted again for each part.
PROPOSED = 2
#: Sketches that tasks' sketches are merged to before they meet in one task.
MERGED = 64


def missed_share(parts: int) -> float:
    """A key that is not proposed holds at most this share of the rows."""
    return 2 * 3.5 * 3 / 4 / (COUNTERS * parts)


def proposed_keys(events: DataFrame, key: str = "user_id", parts: int = SPREAD_PARTS) -> DataFrame:
    """Few keys, among them every one with more than a ``parts``-th of the rows.

    Keys with as much in the sketch hold two thirds of a part at least, so fewer than
    ``PROPOSED`` times ``parts`` of them can push a key off the list.
    """
    counters, most = COUNTERS * parts, PROPOSED * parts
    column = f"`{key}`"
    some = F.pmod(F.spark_partition_id(), F.lit(MERGED)).alias("some")
    sketches = events.groupBy(some).agg(F.expr(f"approx_top_k_accumulate({column}, {counters})").alias("sketch"))
    # grouped, as tasks without a sketch cannot be combined
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch")
    )
    found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("found"))
    return found.select(F.col("found.item").alias(key)).where(F.col(key).isNotNull())


def recounted(events: DataFrame, proposed: DataFrame, key: str = "user_id") -> DataFrame:
    """Exact counts of proposed keys; partial counts of them are all that is shuffled."""
    rows = events.select(key).join(F.broadcast(proposed), key, "left_semi")
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))


def heavy_counts(
    events: DataFrame, key: str = "user_id", parts: int = SPREAD_PARTS, threshold: int = 0
) -> DataFrame:
    """Keys with more than a ``parts``-th of all rows and more than ``threshold``, with their counts.

    A small written table: the set is the same wherever it is used, and has fewer than
    ``parts`` keys by arithmetic. Rows without a key count in the total and are no key.
    """
    spark, path = events.sparkSession, scratch_dir(events.sparkSession, "heavy")
    total = events.select(key).count()
    counts = recounted(events, proposed_keys(events, key, parts), key)
    write_table(counts.where((F.col("event_count") > threshold) & (F.col("event_count") * parts > total)), path)
    return read_table(spark, path)


def top_keys(
    events: DataFrame, top_n: int = TOP_KEYS, key: str = "user_id", parts: int = SPREAD_PARTS
) -> DataFrame:
    """The keys with most rows, equal counts ordered by key; null is a key here.

    Taken from the recounted proposals where those must hold the answer: a key that is not
    proposed has fewer rows than the last of them. Otherwise all keys are counted.
    """
    spark, path = events.sparkSession, scratch_dir(events.sparkSession, "top")
    by_count = [F.col("event_count").desc(), F.col(key)]
    absent = events.where(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("event_count")).where("event_count > 0")
    absent = absent.select(F.lit(None).cast(events.schema[key].dataType).alias(key), "event_count")
    counts = recounted(events, proposed_keys(events, key, parts), key).unionByName(absent)
    write_table(counts.orderBy(*by_count).limit(top_n), path)
    found = read_table(spark, path)
    row = found.agg(F.count(F.lit(1)).alias("n"), F.min("event_count").alias("least")).first()
    if row["n"] == top_n and row["least"] > missed_share(parts) * events.select(key).count():
        return found.orderBy(*by_count)
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("event_count")).orderBy(*by_count).limit(top_n)
