"""Lookups that add attributes to events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.fixed import COUNTRY_VALUES, DEVICE_VALUES


def country_dim(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {COUNTRY_VALUES} AS t(country, country_name, region)")


def device_dim(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {DEVICE_VALUES} AS t(device, form_factor)")


def enrich(events: DataFrame) -> DataFrame:
    """Add country and device attributes; unknown codes keep the event with nulls.

    Both lookups are constants of a few rows, so broadcasting them never grows.
    """
    spark = events.sparkSession
    return events.join(F.broadcast(country_dim(spark)), "country", "left").join(
        F.broadcast(device_dim(spark)), "device", "left"
    )


def look_up(facts: DataFrame, table: DataFrame, fact_key: str, table_key: str) -> DataFrame:
    """Left join to a table of unknown size.

    There is no hint here: Spark broadcasts the table only below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
    where adaptive execution splits a hot key of the facts.
    """
    return facts.join(table, facts[fact_key] == table[table_key], "left")
