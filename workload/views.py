"""Click views of the given ``events`` table.

The given events have no path, device, country or agent, and no dirt. These columns
are derived from the row, in expressions that Spark and DuckDB both read. No row of
the table is left out; purchases arrive twice, as from a producer that retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.fixed import LANDING_TIME_FORMAT

NUMBER_IN_PROPS = "regexp_extract(props, '([0-9]+)', 1)"

CLICK_TYPE = (
    "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'add_to_cart' "
    "WHEN 'error' THEN 'search' ELSE event_type END"
)

CLICKS = [
    "event_id",
    "user_id",
    "ts AS event_timestamp",
    f"{CLICK_TYPE} AS event_type",
    f"'/product/' || {NUMBER_IN_PROPS} AS path",
]

# Anonymous users, absent and blank types, untidy codes, all countries and one unknown, an
# agent for every bot marker. A copy (copy = 1) comes under another event id and referrer.
RAW_FIELDS = [
    "CASE copy WHEN 0 THEN CAST(event_id AS STRING) ELSE 'again-' || CAST(event_id AS STRING) END "
    "AS event_id",
    "CASE WHEN k = '0' THEN NULL ELSE CAST(user_id AS STRING) END AS user_id",
    "CASE event_type WHEN 'view' THEN ' Page_View ' WHEN 'signup' THEN 'add_to_cart' "
    "WHEN 'error' THEN (CASE k WHEN '1' THEN NULL WHEN '2' THEN '  ' ELSE 'SEARCH' END) "
    "ELSE event_type END AS event_type",
    "'/product/' || k AS path",
    "CASE WHEN copy = 1 THEN 'retry' WHEN event_type = 'view' THEN 'direct' END AS referrer",
    "CASE WHEN value < 10 THEN 'Desktop' WHEN value < 30 THEN 'mobile ' "
    "WHEN value < 70 THEN 'tablet' END AS device",
    "CASE event_id % 12 WHEN 0 THEN 'us' WHEN 1 THEN 'CA ' WHEN 2 THEN 'br' WHEN 3 THEN 'GB' "
    "WHEN 4 THEN ' de' WHEN 5 THEN 'Fr' WHEN 6 THEN 'ng' WHEN 7 THEN ' in' WHEN 8 THEN 'jp ' "
    "WHEN 9 THEN 'au' WHEN 10 THEN 'zz' END AS country",
    "CASE event_id % 19 WHEN 0 THEN 'Googlebot/2.1' WHEN 1 THEN 'Site-CRAWLER 3' "
    "WHEN 2 THEN 'Baiduspider+' WHEN 3 THEN 'Python-Requests/2.31.0' WHEN 4 THEN 'AhrefsSiteAudit' "
    "WHEN 5 THEN 'curl/8.5' WHEN 6 THEN 'GNU Wget 1.21' WHEN 7 THEN NULL "
    "ELSE 'Mozilla/5.0 Chrome/124.0' END AS user_agent",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, clean events: what the session operators take."""
    return table(spark, sf_dir, "events").selectExpr(*CLICKS)


def _raw(spark: SparkSession, sf_dir: str, time: str) -> DataFrame:
    copies = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1)))
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", F.expr(NUMBER_IN_PROPS))
        .withColumn("copy", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
        .selectExpr(*RAW_FIELDS, f"{time} AS event_timestamp")
    )


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty events with a real event time: what cleaning takes."""
    return _raw(spark, sf_dir, "ts")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty events with the time as text, unreadable in some: what a producer sends."""
    text = f"date_format(ts, \"{LANDING_TIME_FORMAT}\")"
    return _raw(spark, sf_dir, f"CASE WHEN k = '3' THEN 'soon' ELSE {text} END")
