"""The named queries. Each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.lake import Lake, Settings
from visitfold.operators import heavy, kpis, skew
from visitfold.operators.cleaning import clean_events, drop_repeats, tag_bots
from visitfold.operators.dimensions import enrich, look_up
from visitfold.operators.sessions import (
    build_sessions,
    fold_tagged,
    session_rows,
    tag_sessions,
    window_sessions,
)
from visitfold.plans import jobs
from visitfold.plans.sessions_job import snapshot_job, states_before
from visitfold.sources.landing import (
    CORRUPT,
    read_landing,
    rows_per_day,
    type_events,
    write_landing,
)
from visitfold.sources.bucketed import Buckets
from visitfold.sources.ledger import list_landing
from visitfold.sources.scratch import scratch_dir
from visitfold.sources.tables import between_days, read_table, write_table
from visitfold.streaming import live
from workload.views import clicks, raw_clicks, raw_lines, table

HALF_HOUR = 30 * 60
SIX_HOURS = 6 * 60 * 60
# Users of the given tables have 67 events on average.
HOT = 70
# Of so many parts, a user with more than one is heavy.
PARTS = 140
BUCKETS = 16
SPANS = [("2024-01-03", "2024-01-03"), ("2024-01-08", "2024-01-14"), ("2024-01-01", "2024-01-31")]
MIDDLE, LATE_DAY, SNAPSHOT_DAY = "2024-01-16", "2024-01-15", "2024-01-10"

# Which of several copies stays is open; these differ between copies.
OPEN = ["event_id", "referrer"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain(rows: DataFrame) -> DataFrame:
    """Times without zone and days as text, which every client reads alike."""
    kinds = {"timestamp": "timestamp_ntz", "date": "string"}
    return rows.withColumns(
        {name: F.col(name).cast(kinds[kind]) for name, kind in rows.dtypes if kind in kinds}
    )


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: _plain(run(spark, sf_dir))
    return run


# ---- sessions ---------------------------------------------------------------


@query
def session_tag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_sessions(clicks(spark, sf_dir), SIX_HOURS)


@query
def sessions_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_sessions(clicks(spark, sf_dir), SIX_HOURS)


@query
def sessions_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_tagged(tag_sessions(clicks(spark, sf_dir), SIX_HOURS))


@query
def sessions_half_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_sessions(clicks(spark, sf_dir), HALF_HOUR)


@query
def sessions_exact_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_sessions(clicks(spark, sf_dir), HALF_HOUR, exact=True)


@query
def sessions_window_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_sessions(clicks(spark, sf_dir), HALF_HOUR)


@query
def one_day_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "sessions")
    sessions = build_sessions(clicks(spark, sf_dir), SIX_HOURS)
    write_table(sessions, path, ["event_date"], gather=True)
    return read_table(spark, path, since="2024-01-15", until="2024-01-15").select(
        "user_id", "start_ts", "end_ts", "duration_sec", "num_events", "converted", "bounce"
    )


@query
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "silver")
    silver = jobs.silver_events(
        raw_clicks(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp"))
    )
    write_table(silver, path, ["event_date"], gather=True)
    return read_table(spark, path).drop(*OPEN)


@query
def silver_day_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day is spoilt and rebuilt; the others keep their files."""
    lake = _landed(spark, sf_dir, "lake")
    jobs.bronze_job(spark, lake)
    jobs.silver_job(spark, lake)
    day = read_table(spark, lake.silver, "2024-01-15", "2024-01-15")
    write_table(day.limit(1), lake.silver, ["event_date"], replace="days")
    span = {"since": "2024-01-15", "until": "2024-01-15"}
    jobs.bronze_job(spark, lake, **span)
    jobs.silver_job(spark, lake, **span)
    return read_table(spark, lake.silver).drop(*OPEN, "ingest_ts", "source_file")


@query
def sessions_day_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings, the last one late; each brings its own days and what they change."""
    lake, lines = Lake(scratch_dir(spark, "lake")), raw_lines(spark, sf_dir)
    for part, days in (
        ("first", f"< '{LATE_DAY}'"),
        ("second", f"> '{LATE_DAY}'"),
        ("late", f"= '{LATE_DAY}'"),
    ):
        _land_part(lines, lake, part, days)
        jobs.refresh_job(spark, lake)
    return read_table(spark, lake.sessions)


@query
def sessions_after_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day was loaded with half of its events missing, and is put right."""
    silver = jobs.silver_events(type_events(raw_lines(spark, sf_dir))).drop("ingest_ts")
    lake = Lake(scratch_dir(spark, "lake"))
    day = F.lit(LATE_DAY).cast("date")
    half = (F.col("event_date") != day) | (F.unix_timestamp("event_timestamp") % 2 == 0)
    write_table(silver.where(half), lake.silver, ["event_date"], gather=True)
    jobs.sessions_job(spark, lake)
    write_table(silver.where(F.col("event_date") == day), lake.silver, ["event_date"], replace="days")
    jobs.sessions_job(spark, lake, since=LATE_DAY, until=LATE_DAY)
    return read_table(spark, lake.sessions)


@query
def sessions_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events bucketed by user, the heavy users apart; neither part is shuffled by user whole."""
    path = scratch_dir(spark, "buckets")
    buckets = Buckets(f"buckets_{path.rsplit('-', 1)[-1]}", path, BUCKETS)
    buckets.write(clicks(spark, sf_dir))
    parts = [build_sessions(part, SIX_HOURS) for part in (buckets.usual(spark), buckets.heavy(spark))]
    return parts[0].unionByName(parts[1])


@query
def session_states_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's sessions so far and last session at the end of a day, through a snapshot."""
    lake = Lake(scratch_dir(spark, "lake"))
    events = clicks(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp"))
    write_table(events, lake.silver, ["event_date"], gather=True)
    jobs.sessions_job(spark, lake)
    snapshot_job(spark, lake, SNAPSHOT_DAY)
    return states_before(spark, lake, LATE_DAY).select(
        *("user_id", "event_date", "sessions", "num_events", "num_pageviews", "purchases"),
        F.col("entry.path").alias("entry_path"),
        F.col("exit.event_timestamp").alias("end_ts"),
    )


# ---- landing and bronze -----------------------------------------------------


@query
def landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_day(raw_lines(spark, sf_dir))


@query
def landing_day_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "landing")
    write_landing(raw_lines(spark, sf_dir), path)
    folder = F.regexp_extract("source_file", "event_date=([^/]+)/", 1)
    return (
        read_landing(spark, path)
        .groupBy(folder.alias("folder"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def bronze_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "landing")
    write_landing(raw_lines(spark, sf_dir), path)
    events = type_events(read_landing(spark, path))
    return events.drop("ingest_ts", "source_file", CORRUPT)


@query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line has the time at which its load began, the same for a whole load."""
    path = scratch_dir(spark, "landing")
    write_landing(raw_lines(spark, sf_dir), path)
    return type_events(read_landing(spark, path)).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("ingest_ts").alias("ingested"),
        F.countDistinct("ingest_ts").alias("loads"),
    )


@query
def bronze_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of some lines is lost on the way; they stay countable and readable."""
    path = scratch_dir(spark, "landing")
    lines = raw_lines(spark, sf_dir)
    whole = F.to_json(F.struct(*lines.columns))
    cut = F.when(F.col("path") == "/product/4", whole.substr(F.lit(1), F.length(whole) / 2))
    lines.select(F.coalesce(cut, whole).alias("value")).write.option("compression", "gzip").text(
        path
    )
    events = type_events(read_landing(spark, path))
    return events.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(CORRUPT).alias("corrupt_lines"),
        F.count_if(F.col(CORRUPT).startswith("{")).alias("kept_texts"),
        F.count_if(F.col(CORRUPT).isNull() & F.col("event_timestamp").isNull()).alias("bad_times"),
    )


def _land_path(lines: DataFrame, lake: Lake, part: str, paths: str) -> None:
    write_landing(lines.where(f"path {paths}"), f"{lake.landing}/{part}")


@query
def bronze_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings and two loads; the second reads the files that the first has not."""
    lake, lines = Lake(scratch_dir(spark, "lake")), raw_lines(spark, sf_dir)
    for part, paths in (("first", "<> '/product/1'"), ("second", "= '/product/1'")):
        _land_path(lines, lake, part, paths)
        jobs.load_job(spark, lake)
    return read_table(spark, lake.bronze).drop("ingest_ts", "source_file", CORRUPT)


@query
def bronze_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files a day needs, by the ledger, against the rows of that day in all others."""
    lake = _landed(spark, sf_dir, "lake")
    jobs.load_job(spark, lake)
    chosen = jobs.range_files(spark, lake, LATE_DAY, LATE_DAY)
    bronze = read_table(spark, lake.bronze).where(F.col("event_date") == F.lit(LATE_DAY).cast("date"))
    names = spark.createDataFrame([(path,) for path in chosen], "path STRING")
    listed = list_landing(spark, lake.landing)
    files = listed.join(names, "path", "left_semi").select("source_file")
    fewer = listed.count() > files.count()
    left = bronze.join(files, "source_file", "left_anti").agg(F.count(F.lit(1)).alias("rows_elsewhere"))
    read = type_events(read_landing(spark, chosen)).where(F.col("event_date") == F.lit(LATE_DAY).cast("date"))
    found = read.agg(F.count(F.lit(1)).alias("rows_read"))
    return found.crossJoin(left).withColumn("fewer_files", F.lit(fewer))


@query
def bronze_file_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part of the landing zone is delivered anew without some rows; bronze follows."""
    lake, lines = Lake(scratch_dir(spark, "lake")), raw_lines(spark, sf_dir)
    _land_path(lines, lake, "first", "<> '/product/1'")
    _land_path(lines, lake, "second", "= '/product/1'")
    jobs.load_job(spark, lake)
    _land_path(lines.where("event_type IS NOT NULL"), lake, "second", "= '/product/1'")
    jobs.load_job(spark, lake)
    return read_table(spark, lake.bronze).drop("ingest_ts", "source_file", CORRUPT)


@query
def layer_survives_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that fails in the middle of replacing a layer leaves the layer as it was."""
    path = scratch_dir(spark, "silver")
    silver = jobs.silver_events(
        raw_clicks(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp"))
    )
    write_table(silver, path, ["event_date"], gather=True)
    lost = F.when(F.col("path") == "/product/7", F.raise_error(F.lit("lost"))).otherwise(F.col("path"))
    try:
        write_table(read_table(spark, path).withColumn("path", lost), path, ["event_date"])
    except Exception as error:
        if "lost" not in str(error):
            raise
    return read_table(spark, path).drop(*OPEN)


# ---- silver -----------------------------------------------------------------


@query
def silver_bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        tag_bots(raw_clicks(spark, sf_dir))
        .groupBy("is_bot")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(clean_events(raw_clicks(spark, sf_dir)), prefer=[F.col("event_id")])


@query
def silver_first_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = drop_repeats(clean_events(raw_clicks(spark, sf_dir)), prefer=[F.col("event_id")])
    return drop_repeats(events, ["user_id", "path"], [F.col("event_timestamp"), F.col("event_id")])


@query
def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(drop_repeats(clean_events(raw_clicks(spark, sf_dir)))).drop(*OPEN)


@query
def star_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = clicks(spark, sf_dir)
    for name, fact_key, table_key in [
        ("customer", "user_id", "c_custkey"),
        ("nation", "c_nationkey", "n_nationkey"),
        ("region", "n_regionkey", "r_regionkey"),
    ]:
        events = look_up(events, table(spark, sf_dir, name), fact_key, table_key)
    return events.select("event_id", "user_id", "event_type", "c_mktsegment", "n_name", "r_name")


@query
def silver_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most events come again in other files, with new ones; silver takes the new ones."""
    lake, lines = Lake(scratch_dir(spark, "lake")), raw_lines(spark, sf_dir)
    for part, paths in (("first", "<> '/product/1'"), ("again", "<> '/product/2'"), ("third", "IS NOT NULL")):
        _land_path(lines, lake, part, paths)
        new = type_events(read_landing(spark, f"{lake.landing}/{part}"))
        jobs.append_silver_job(spark, lake, new.drop("ingest_ts", "source_file"), part)
    return read_table(spark, lake.silver).drop(*OPEN)


# ---- gold -------------------------------------------------------------------


@query
def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.events_by_type(clicks(spark, sf_dir))


@query
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.funnel(clicks(spark, sf_dir)).orderBy("stage")


@query
def daily_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.daily_sessions(build_sessions(clicks(spark, sf_dir), SIX_HOURS))


@query
def daily_sessions_unrounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = build_sessions(clicks(spark, sf_dir), HALF_HOUR)
    return kpis.daily_sessions(sessions, rounded=False)


@query
def span_users_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of spans of days from a table with a row per day, users by sketches."""
    path = scratch_dir(spark, "days")
    write_table(kpis.daily_sketches(build_sessions(clicks(spark, sf_dir), SIX_HOURS)), path, ["event_date"])
    sessions = build_sessions(clicks(spark, sf_dir), SIX_HOURS)
    rows = []
    for since, until in SPANS:
        told = kpis.span_sessions(read_table(spark, path, since, until))
        exact = between_days(sessions, since, until).agg(F.countDistinct("user_id").alias("users"))
        off = F.abs(F.col("distinct_users") - F.col("users")) <= kpis.USER_ERROR * F.col("users")
        rows.append(
            told.crossJoin(exact).select(
                F.lit(since).alias("since"),
                *("num_sessions", "avg_duration_sec", "bounce_rate", "conversion_rate"),
                off.alias("users_within_error"),
            )
        )
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def top_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.top_paths(build_sessions(clicks(spark, sf_dir), SIX_HOURS))


@query
def sessions_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.sessions_per_user(build_sessions(clicks(spark, sf_dir), SIX_HOURS))


@query
def returning_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.returning_users(build_sessions(clicks(spark, sf_dir), SIX_HOURS))


# ---- skew -------------------------------------------------------------------


@query
def key_skew_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.key_skew_report(clicks(spark, sf_dir))


@query
def hottest_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.key_skew_report(clicks(spark, sf_dir), top_n=1)


@query
def hot_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.hot_keys(clicks(spark, sf_dir), HOT)


@query
def heavy_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with more than their part of the events, by a sketch of bounded size."""
    return heavy.heavy_counts(clicks(spark, sf_dir), parts=PARTS)


@query
def top_users_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy.top_keys(clicks(spark, sf_dir))


@query
def naive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.naive_counts(clicks(spark, sf_dir))


@query
def salted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.salted_counts(clicks(spark, sf_dir), spread_by=["event_id"])


@query
def hot_salted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.hot_salted_counts(clicks(spark, sf_dir), HOT, spread_by=["event_id"])


@query
def skew_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.skew_check(clicks(spark, sf_dir), spread_by=["event_id"])


@query
def salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id", "c_name", "c_mktsegment"
    )
    joined = skew.salted_left_join(
        clicks(spark, sf_dir), users.hint("merge"), "user_id", HOT, spread_by=["event_id"]
    )
    return joined.select("event_id", "user_id", "c_name", "c_mktsegment")


# ---- whole runs -------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str, label: str) -> Lake:
    lake = Lake(scratch_dir(spark, label))
    write_landing(raw_lines(spark, sf_dir), lake.landing)
    return lake


def _gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table, of a lake with the layers that it needs."""
    lake = _landed(spark, sf_dir, "lake")
    layers = [jobs.bronze_job, jobs.silver_job]
    for job in layers + [jobs.sessions_job] * (jobs.GOLD[name] == "sessions"):
        job(spark, lake, Settings())
    jobs.gold_job(spark, lake, Settings(), only=[name])
    return read_table(spark, lake.gold(name))


@query
def batch_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _landed(spark, sf_dir, "lake")
    jobs.bronze_job(spark, lake)
    return read_table(spark, lake.bronze).drop("ingest_ts", "source_file", CORRUPT)


@query
def batch_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "funnel")


@query
def batch_daily_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "daily_sessions")


@query
def batch_top_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "top_paths")


@query
def batch_returning_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "returning_users")


@query
def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _landed(spark, sf_dir, "lake")
    rows = jobs.batch_job(spark, lake, Settings())
    return spark.createDataFrame(list(rows.items()), "layer STRING, rows LONG")


def _streamed(spark: SparkSession, sf_dir: str, clean: bool, end: str) -> DataFrame:
    lake = _landed(spark, sf_dir, "stream")
    query = jobs.stream_job(spark, lake, Settings(), sink="parquet", clean=clean, end=end)
    return read_table(spark, lake.stream_table(query.name))


@query
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, clean=False, end="last_event")


@query
def stream_sessions_window_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, clean=False, end="window")


@query
def stream_sessions_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, clean=True, end="last_event")


TWENTY_DAYS = 20 * 24 * 60 * 60


@query
def stream_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several batches; the lateness covers the order in which days were written, ten at a time."""
    lake, settings = Lake(scratch_dir(spark, "stream")), Settings(lateness_seconds=TWENTY_DAYS)
    write_landing(raw_lines(spark, sf_dir), lake.landing, days_at_once=10)
    query = jobs.stream_job(
        spark, lake, settings, sink="parquet", clean=False, files_per_batch=8
    )
    return read_table(spark, lake.stream_table(query.name))


def _land_part(lines: DataFrame, lake: Lake, part: str, days: str) -> None:
    """Events of some days; what has no day cannot be placed in a session and comes along."""
    day = "to_date(try_to_timestamp(event_timestamp))"
    # the time's text is read once for the test, not twice
    write_landing(lines.where(f"coalesce({day} {days}, TRUE)"), f"{lake.landing}/{part}")


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint; the second goes on with the sessions left open."""
    lake, lines = Lake(scratch_dir(spark, "stream")), raw_lines(spark, sf_dir)
    for part, days in (("first", f"< '{MIDDLE}'"), ("second", f">= '{MIDDLE}'")):
        _land_part(lines, lake, part, days)
        query = jobs.stream_job(spark, lake, Settings(), sink="parquet", clean=False)
    return read_table(spark, lake.stream_table(query.name))


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day that lands after the others, beyond the lateness, is left out."""
    lake, lines = Lake(scratch_dir(spark, "stream")), raw_lines(spark, sf_dir)
    for part, days in (("punctual", f"<> '{LATE_DAY}'"), ("late", f"= '{LATE_DAY}'")):
        _land_part(lines, lake, part, days)
        query = jobs.stream_job(
            spark, lake, Settings(), sink="parquet", clean=False, allow_late=True
        )
    return read_table(spark, lake.stream_table(query.name))


@query
def stream_late_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same day, late again, is kept in a table and its users' sessions are built anew."""
    lake, lines = Lake(scratch_dir(spark, "stream")), raw_lines(spark, sf_dir)
    for part, days in (("punctual", f"<> '{LATE_DAY}'"), ("late", f"= '{LATE_DAY}'")):
        _land_part(lines, lake, part, days)
        jobs.stream_job(spark, lake, Settings(), sink="parquet", clean=False, keep_late=True)
    jobs.repair_job(spark, lake, Settings(), clean=False)
    return read_table(spark, lake.stream_table("live_sessions_raw_repaired"))


def _numbered(spark: SparkSession, sf_dir: str) -> tuple[Lake, str]:
    """Closed sessions with index and id, of two runs on one checkpoint."""
    lake, lines = Lake(scratch_dir(spark, "stream")), raw_lines(spark, sf_dir)
    for part, days in (("first", f"< '{MIDDLE}'"), ("second", f">= '{MIDDLE}'")):
        _land_part(lines, lake, part, days)
        query = jobs.stream_job(spark, lake, Settings(), sink="table", clean=False)
    return lake, query.name


@query
def stream_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, name = _numbered(spark, sf_dir)
    return read_table(spark, lake.stream_table(f"{name}_numbered"))


@query
def stream_with_open_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions and those that the state store still holds: all there are."""
    lake, name = _numbered(spark, sf_dir)
    names = ["user_id", "start_ts", "end_ts", "num_events", "num_pageviews", "converted", "entry_path", "exit_path"]
    closed = read_table(spark, lake.stream_table(f"{name}_numbered")).select(*names)
    still = live.open_sessions(spark, lake.checkpoint(name, "table"))
    still = session_rows(still.withColumn("session_id", F.lit(None).cast("string"))).select(*names)
    return closed.withColumn("closed", F.lit(True)).unionByName(still.withColumn("closed", F.lit(False)))
