"""Hot keys: finding them, counting and joining around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitfold.fixed import HOT_KEY_THRESHOLD, SALT_FACTOR, TOP_KEYS
from visitfold.functions.salting import row_salt
from visitfold.operators.heavy import SPREAD_PARTS, heavy_counts
from visitfold.sources.scratch import scratch_dir
from visitfold.sources.tables import read_table, write_table


def naive_counts(events: DataFrame, key: str = "user_id") -> DataFrame:
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))


def largest_keys(counts: DataFrame, top_n: int = TOP_KEYS, key: str = "user_id") -> DataFrame:
    """The keys with most rows; equal counts are ordered by key."""
    return counts.orderBy(F.col("event_count").desc(), F.col(key)).limit(top_n)


def key_skew_report(events: DataFrame, top_n: int = TOP_KEYS, key: str = "user_id") -> DataFrame:
    return largest_keys(naive_counts(events, key), top_n, key)


def hot_keys(
    events: DataFrame, threshold: int = HOT_KEY_THRESHOLD, key: str = "user_id"
) -> DataFrame:
    """Every key with more than ``threshold`` rows; their number grows with the data."""
    counts = naive_counts(events, key)
    return counts.where(F.col(key).isNotNull() & (F.col("event_count") > threshold)).select(key)


def written_counts(events: DataFrame, key: str = "user_id") -> DataFrame:
    """``naive_counts`` as a table in the scratch folder, for use more than once."""
    path = scratch_dir(events.sparkSession, "counts")
    write_table(naive_counts(events, key), path)
    return read_table(events.sparkSession, path)


def heavy_keys(
    counts: DataFrame, parts: int = SPREAD_PARTS, key: str = "user_id", threshold: int = 0
) -> DataFrame:
    """Keys with more than ``threshold`` rows and more than a ``parts``-th of all rows.

    ``counts`` are written counts, so the set is the same wherever it is used. It has fewer
    than ``parts`` keys by arithmetic and is broadcast for that reason; a key that is not in
    it holds at most one part's share, or ``threshold`` rows.
    """
    total = counts.agg(F.sum("event_count")).first()[0] or 0
    heavy = (F.col("event_count") > threshold) & (F.col("event_count") * parts > total)
    return F.broadcast(counts.where(F.col(key).isNotNull() & heavy).select(key))


def salted(
    events: DataFrame,
    factor: int = SALT_FACTOR,
    key: str = "user_id",
    hot: DataFrame | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Events with a ``salt`` column; with ``hot`` given, other keys keep salt 0.

    A missing key counts as hot: it matches nothing, but may well be the largest group.
    The salt is hashed from the ``spread_by`` columns. Name a narrow one that differs
    between a key's rows, or the scan has to read every column. ``hot`` is joined as it
    comes: ``heavy_keys`` is broadcast, other sets by their size.
    """
    bucket = row_salt(spread_by or events.columns, factor)
    if hot is None:
        return events.withColumn("salt", bucket)
    marked = events.join(hot.withColumn("_hot", F.lit(True)), key, "left")
    spread = F.col("_hot") | F.col(key).isNull()
    return marked.select(*events.columns, F.when(spread, bucket).otherwise(F.lit(0)).alias("salt"))


def salted_counts(
    events: DataFrame,
    factor: int = SALT_FACTOR,
    key: str = "user_id",
    hot: DataFrame | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Same result as ``naive_counts``, counted per (key, salt) first."""
    partial = (
        salted(events, factor, key, hot, spread_by)
        .groupBy(key, "salt")
        .agg(F.count(F.lit(1)).alias("partial_count"))
    )
    return partial.groupBy(key).agg(F.sum("partial_count").alias("event_count"))


def hot_salted_counts(
    events: DataFrame,
    threshold: int = HOT_KEY_THRESHOLD,
    factor: int = SALT_FACTOR,
    key: str = "user_id",
    spread_by: list[str] | None = None,
    parts: int = SPREAD_PARTS,
) -> DataFrame:
    """Counts with the heavy keys salted: those above the threshold that hold over a ``parts``-th.

    Heavy keys come from a sketch of bounded size. A key above the threshold that holds less
    is no burden to a task and is counted as it is.
    """
    hot = F.broadcast(heavy_counts(events, key, parts, threshold).select(key))
    return salted_counts(events, factor, key, hot, spread_by)


def salted_left_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    threshold: int = HOT_KEY_THRESHOLD,
    factor: int = SALT_FACTOR,
    spread_by: list[str] | None = None,
    parts: int = SPREAD_PARTS,
) -> DataFrame:
    """Left join on ``key`` with the heavy keys of ``big`` spread over ``factor`` tasks.

    The heavy keys are found once, by a sketch and a recount, and written, so both sides agree
    on them. Only their rows of ``small`` are repeated, once per salt.
    """
    hot = F.broadcast(heavy_counts(big, key, parts, threshold).select(key))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(factor - 1))).otherwise(
        F.array(F.lit(0))
    )
    spread = small.join(hot.withColumn("_hot", F.lit(True)), key, "left").select(
        *small.columns, F.explode(salts).alias("salt")
    )
    return salted(big, factor, key, hot, spread_by).join(spread, [key, "salt"], "left").drop("salt")


def skew_check(
    events: DataFrame,
    factor: int = SALT_FACTOR,
    key: str = "user_id",
    hot: DataFrame | None = None,
    spread_by: list[str] | None = None,
    naive: DataFrame | None = None,
) -> DataFrame:
    """One row: both totals, how many keys differ, the largest key, the factor.

    With ``hot`` given, only those keys are salted. ``naive`` are plain counts that are
    already there.
    """
    zero = F.lit(0).cast("long")
    plain = naive_counts(events, key) if naive is None else naive
    both = plain.select(
        key, F.col("event_count").alias("naive"), zero.alias("salted")
    ).unionByName(
        salted_counts(events, factor, key, hot, spread_by).select(
            key, zero.alias("naive"), F.col("event_count").alias("salted")
        )
    )
    per_key = both.groupBy(key).agg(F.sum("naive").alias("naive"), F.sum("salted").alias("salted"))
    return per_key.agg(
        F.coalesce(F.sum("naive"), zero).alias("naive_total_events"),
        F.coalesce(F.sum("salted"), zero).alias("salted_total_events"),
        F.count_if(F.col("naive") != F.col("salted")).alias("differing_keys"),
        F.coalesce(F.max("naive"), zero).alias("hottest_user_events"),
    ).select(
        "naive_total_events",
        "salted_total_events",
        "differing_keys",
        (F.col("differing_keys") == 0).cast("int").alias("totals_match"),
        "hottest_user_events",
        F.lit(factor).alias("salt_factor"),
    )
