"""One local session for all tests."""

from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from visitfold.lake import SPARK_SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("visitfold-tests")
        .config(map=SPARK_SETTINGS)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def visits(spark):
    """Events from (user, time, type, path) rows; times as text."""

    def build(rows):
        return spark.createDataFrame(
            [(user, at(time), kind, path) for user, time, kind, path in rows],
            "user_id STRING, event_timestamp TIMESTAMP, event_type STRING, path STRING",
        )

    return build


def at(text: str | None) -> datetime | None:
    """A bare time is one on the first of August; a full ISO time is taken as it is."""
    if text is None:
        return None
    return datetime.fromisoformat(text if "-" in text else f"2026-08-01 {text}")


def plan(df) -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
