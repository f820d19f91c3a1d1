from __future__ import annotations

import pytest
from conftest import at, plan
from pyspark.sql import functions as F

from visitfold.operators.cleaning import clean_events, drop_repeats, normalise, tag_bots, usable
from visitfold.operators.dimensions import country_dim, device_dim, enrich, look_up
from visitfold.plans.jobs import silver_events

HUMAN = "Opera/9.80 (Android; Linux)"

# Written out, so that a wrong entry in the engine's list is seen.
MARKERS = ["ahrefs", "bot", "crawler", "curl", "python-requests", "spider", "wget"]


@pytest.fixture(scope="module")
def bronze(spark):
    def build(*rows):
        base = {
            "event_id": "1",
            "user_id": "u1",
            "event_timestamp": at("10:00:00"),
            "event_type": "page_view",
            "path": "/a",
            "referrer": "direct",
            "device": "mobile",
            "country": "us",
            "user_agent": HUMAN,
            "event_date": at("10:00:00").date(),
            "ingest_ts": at("10:00:00"),
            "source_file": "file:/x",
        }
        fields = (
            "event_id STRING, user_id STRING, event_timestamp TIMESTAMP, event_type STRING, "
            "path STRING, referrer STRING, device STRING, country STRING, user_agent STRING, "
            "event_date DATE, ingest_ts TIMESTAMP, source_file STRING"
        )
        return spark.createDataFrame([tuple((base | row).values()) for row in rows], fields)

    return build


def test_bots_are_dropped(bronze):
    agents = [HUMAN, "YandexBot/3.0", "curl 8", "Robotics fan club", "Scrapy", "Bytespider; x", "Curious/1"]
    events = bronze(*[{"user_id": agent, "user_agent": agent} for agent in agents])
    assert {r["user_id"] for r in silver_events(events).collect()} == {HUMAN, "Scrapy", "Curious/1"}


@pytest.mark.parametrize("marker", MARKERS)
def test_every_marker_in_any_case(bronze, marker):
    events = bronze({"user_agent": f"x{marker.upper()}y"}, {"user_agent": f"-{marker.title()}/1"})
    assert [r["is_bot"] for r in tag_bots(events).collect()] == [True, True]


def test_missing_agent_is_a_person(bronze):
    events = bronze({"user_agent": None}, {"user_agent": ""})
    assert [r["is_bot"] for r in tag_bots(events).collect()] == [False, False]


def test_rows_without_key_are_dropped(bronze):
    events = bronze({}, {"user_id": None}, {"event_timestamp": None}, {"event_type": None})
    assert usable(events).count() == 1
    assert silver_events(events).count() == 1


def test_blank_type_is_present(bronze):
    (row,) = clean_events(bronze({"event_type": "  "})).collect()
    assert row["event_type"] == ""


def test_codes_are_normalised(bronze):
    (row,) = normalise(
        bronze({"event_type": " Page_View ", "device": "MOBILE ", "country": " gb"})
    ).collect()
    assert (row["event_type"], row["device"], row["country"]) == ("page_view", "mobile", "GB")


def test_copies_are_dropped(bronze):
    """One field of the key at a time makes another event; other fields make a copy."""
    others = [
        {"user_id": "u9"},
        {"event_timestamp": at("10:00:00.000001")},
        {"event_type": "search"},
        {"path": "/a/"},
    ]
    copies = [{}, {"event_id": "77", "referrer": None}, {"device": "tv", "country": None}]
    assert silver_events(bronze(*copies, *others, *others)).count() == 5


def test_event_id_is_no_part_of_the_key(bronze):
    events = bronze({"event_id": "1"}, {"event_id": "2"}, {"event_id": "3", "event_type": "PAGE_VIEW "})
    assert silver_events(events).count() == 1


def test_preferred_copy_stays(bronze):
    events = bronze(*[{"event_id": str(n)} for n in (5, 3, 9)])
    (row,) = drop_repeats(events, prefer=[F.col("event_id").desc()]).collect()
    assert row["event_id"] == "9"


def test_null_paths_are_equal_keys(bronze):
    assert drop_repeats(bronze({"path": None}, {"path": None})).count() == 1


def test_attributes_are_added(bronze):
    row = silver_events(bronze({"country": " ng ", "device": "Tablet"})).first()
    assert (row["country_name"], row["region"], row["form_factor"]) == (
        "Nigeria",
        "EMEA",
        "medium_screen",
    )


def test_unknown_codes_keep_the_event(bronze):
    rows = enrich(bronze({"country": "ZZ", "device": None}, {"country": None, "device": "tv"})).collect()
    assert len(rows) == 2
    assert all(r["country_name"] is None and r["form_factor"] is None for r in rows)


def test_silver_columns(bronze):
    assert set(silver_events(bronze({})).columns) == {
        *"event_id user_id event_timestamp event_type path referrer device country user_agent".split(),
        *"event_date ingest_ts source_file country_name region form_factor".split(),
    }


def test_dimension_sizes(spark):
    assert country_dim(spark).count() == 10 and device_dim(spark).count() == 3


def test_only_constant_tables_are_broadcast_by_hint(spark, bronze):
    events = bronze({})
    text = plan(enrich(events))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    big = spark.range(10).withColumnRenamed("id", "k")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = look_up(spark.range(10), big, "id", "k")
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_null_tests_reach_the_scan(spark, bronze, tmp_path):
    path = str(tmp_path / "bronze")
    bronze({}).write.parquet(path)
    text = plan(clean_events(spark.read.parquet(path)))
    for name in ("user_id", "event_timestamp", "event_type"):
        assert f"IsNotNull({name})" in text


def test_copies_are_combined_before_the_shuffle(spark, bronze):
    text = plan(drop_repeats(bronze({}, {})))
    assert "partial_first" in text[text.rindex("Exchange") :]
