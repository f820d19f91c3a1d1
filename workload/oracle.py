"""DuckDB SQL for the named queries.

Sessions are written here in the textbook way, ``lag`` and a running sum over all
events of a user, and not by slices. Copies of an event have equal times; the running
sum takes the opening one first, or the copies would count for the session before.
"""

from __future__ import annotations

from workload.views import CLICKS, NUMBER_IN_PROPS, RAW_FIELDS

# Written out here and not taken from the engine, so that a wrong entry there is seen.
IS_BOT = "regexp_matches(lower(coalesce(user_agent, '')), 'bot|crawler|spider|python-requests|ahrefs|curl|wget')"
# The countries and devices that are known, as the engine has them too.
COUNTRIES = """
    ('US', 'United States', 'Americas'), ('CA', 'Canada', 'Americas'), ('BR', 'Brazil', 'Americas'),
    ('GB', 'United Kingdom', 'EMEA'), ('DE', 'Germany', 'EMEA'), ('FR', 'France', 'EMEA'),
    ('NG', 'Nigeria', 'EMEA'), ('IN', 'India', 'APAC'), ('JP', 'Japan', 'APAC'), ('AU', 'Australia', 'APAC')"""
DEVICES = "('desktop', 'large_screen'), ('tablet', 'medium_screen'), ('mobile', 'small_screen')"
FIELD_NAMES = (
    "event_id, user_id, event_timestamp, event_type, path, referrer, device, country, user_agent"
)

HALF_HOUR = 30 * 60
SIX_HOURS = 6 * 60 * 60

CLICKS_CTE = f"clicks AS (SELECT {', '.join(CLICKS)} FROM events)"


def raw_cte(time: str) -> str:
    return f"""
    numbered_props AS (SELECT *, {NUMBER_IN_PROPS} AS k FROM events),
    delivered AS (
        SELECT *, 0 AS copy FROM numbered_props
        UNION ALL
        SELECT *, 1 AS copy FROM numbered_props WHERE event_type = 'purchase'),
    raw AS (SELECT {', '.join(RAW_FIELDS)}, {time} AS event_timestamp FROM delivered)"""


RAW_CTE = raw_cte("ts")
# What becomes of the text times: unreadable ones are null.
LANDED_CTE = raw_cte("CASE WHEN k = '3' THEN NULL ELSE ts END")

SILVER_CTE = f"""
    normal AS (
        SELECT event_id, user_id, lower(trim(event_type)) AS event_type, path, referrer,
            lower(trim(device)) AS device, upper(trim(country)) AS country, user_agent,
            event_timestamp
        FROM raw
        WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL AND event_type IS NOT NULL
          AND NOT {IS_BOT}),
    silver AS (
        SELECT * FROM normal QUALIFY row_number() OVER (
            PARTITION BY user_id, event_timestamp, event_type, path ORDER BY event_id) = 1)"""

DIMS_CTE = f"""
    countries(country, country_name, region) AS (VALUES {COUNTRIES}),
    devices(device, form_factor) AS (VALUES {DEVICES})"""


def tagged_cte(source: str, gap: int, exact: bool = False) -> str:
    if exact:
        pause = f"event_timestamp - previous > INTERVAL {gap} SECOND"
    else:
        pause = (
            "CAST(floor(epoch(event_timestamp)) AS BIGINT) - CAST(floor(epoch(previous)) AS BIGINT) "
            f"> {gap}"
        )
    return f"""
    paused AS (
        SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp) AS previous
        FROM {source}),
    opened AS (
        SELECT *, CASE WHEN previous IS NULL OR {pause} THEN 1 ELSE 0 END AS opens FROM paused),
    tagged AS (
        SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY event_timestamp, opens DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_index
        FROM opened)"""


SESSION_ID = "sha256(concat_ws('|', CAST(user_id AS VARCHAR), CAST(session_index AS VARCHAR)))"
SECONDS = (
    "CAST(floor(epoch(max(event_timestamp))) AS BIGINT) "
    "- CAST(floor(epoch(min(event_timestamp))) AS BIGINT)"
)

SESSIONS_CTE = f"""
    sessions AS (
        SELECT {SESSION_ID} AS session_id, user_id,
            min(event_timestamp) AS start_ts, max(event_timestamp) AS end_ts,
            count(*) AS num_events,
            count(*) FILTER (WHERE event_type = 'page_view') AS num_pageviews,
            count(*) FILTER (WHERE event_type = 'purchase') > 0 AS converted,
            first(path ORDER BY event_timestamp, path) AS entry_path,
            last(path ORDER BY event_timestamp, path) AS exit_path,
            {SECONDS} AS duration_sec,
            count(*) = 1 AS bounce,
            CAST(CAST(min(event_timestamp) AS DATE) AS VARCHAR) AS event_date
        FROM tagged GROUP BY user_id, session_index)"""


def sessions(gap: int, final: str, exact: bool = False) -> str:
    return f"WITH {CLICKS_CTE}, {tagged_cte('clicks', gap, exact)}, {SESSIONS_CTE} {final}"


def rounded(value: str, digits: int) -> str:
    """Half up on the decimal digits of a mean."""
    return f"CAST(round(CAST(avg({value}) AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def stream(ready: str, source: str, end: str, lateness: int = 2 * HALF_HOUR) -> str:
    """Sessions whose window closed by the last watermark: newest time less the lateness."""
    window_end = f"max(event_timestamp) + INTERVAL {HALF_HOUR} SECOND"
    if end == "window":
        closing = f"{window_end} AS end_ts, {SECONDS} + {HALF_HOUR} AS duration_sec"
    else:
        closing = (
            f"max(event_timestamp) AS end_ts, {SECONDS} AS duration_sec, {window_end} AS window_end"
        )
    return f"""
    WITH {LANDED_CTE}, {ready}, {tagged_cte(source, HALF_HOUR, exact=True)}
    SELECT user_id, min(event_timestamp) AS start_ts, {closing},
        count(*) AS num_events,
        count(*) FILTER (WHERE event_type = 'page_view') AS num_pageviews,
        count(*) FILTER (WHERE event_type = 'purchase') > 0 AS converted
    FROM tagged GROUP BY user_id, session_index
    HAVING {window_end} <= (
        SELECT date_trunc('millisecond', max(event_timestamp)) - INTERVAL {lateness} SECOND
        FROM {source})"""


IDENTIFIED_CTE = (
    "identified AS (SELECT * FROM raw WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL)"
)
# By when the window of a session has to end for the stream to have closed it.
CLOSED_BY = (
    f"(SELECT date_trunc('millisecond', max(event_timestamp)) - INTERVAL {2 * HALF_HOUR} SECOND FROM identified)"
)
SILVER_COLUMNS = (
    "event_id, user_id, event_type, path, referrer, device, country, user_agent, event_timestamp"
)
# Which of several copies stays is open, so their ids and referrers are left out.
OPEN_COLUMNS = "user_id, event_type, path, device, country, user_agent, event_timestamp"
ENRICHED = f"""
    SELECT {OPEN_COLUMNS}, country_name, region, form_factor
    FROM silver LEFT JOIN countries USING (country) LEFT JOIN devices USING (device)"""
COUNTS = "SELECT user_id, count(*) AS event_count FROM events GROUP BY user_id"
DAY = "'2024-01-15'"



def landed(final: str) -> str:
    """Over the layers that the batch job writes from the landing zone."""
    tagged = tagged_cte("silver", HALF_HOUR)
    return f"WITH {LANDED_CTE}, {SILVER_CTE}, {tagged}, {SESSIONS_CTE} {final}"


FUNNEL = """
        counted AS (
            SELECT count(*) FILTER (WHERE event_type = 'page_view') AS views,
                count(*) FILTER (WHERE event_type = 'add_to_cart') AS carts,
                count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM {source})
        SELECT '1_view' AS stage, views AS count, CAST(1 AS DOUBLE) AS rate_from_view FROM counted
        UNION ALL
        SELECT '2_add_to_cart', carts, coalesce(carts / CAST(nullif(views, 0) AS DOUBLE), 0)
        FROM counted
        UNION ALL
        SELECT '3_purchase', purchases, coalesce(purchases / CAST(nullif(views, 0) AS DOUBLE), 0)
        FROM counted"""
DAILY = f"""
    SELECT event_date, count(*) AS num_sessions, count(DISTINCT user_id) AS distinct_users,
        {rounded('duration_sec', 1)} AS avg_duration_sec,
        {rounded('CAST(bounce AS INT)', 4)} AS bounce_rate,
        {rounded('CAST(converted AS INT)', 4)} AS conversion_rate
    FROM sessions GROUP BY event_date ORDER BY event_date"""
TOP_PATHS = """
    SELECT entry_path, count(*) AS sessions FROM sessions GROUP BY entry_path
    ORDER BY sessions DESC, entry_path LIMIT 15"""
RETURNING = """
    SELECT count(*) AS total_users, count(*) FILTER (WHERE n > 1) AS returning_users,
        round(count(*) FILTER (WHERE n > 1) / CAST(count(*) AS DOUBLE), 4) AS returning_rate
    FROM (SELECT user_id, count(*) AS n FROM sessions GROUP BY user_id)"""
# The newest third of the days is closed by a lateness of twenty days.
TWENTY_DAYS = 20 * 24 * 60 * 60
PUNCTUAL_CTE = (
    f"punctual AS (SELECT * FROM identified WHERE CAST(event_timestamp AS DATE) <> {DAY})"
)

ORACLE: dict[str, str] = {
    "session_tag_events": f"""
        WITH {CLICKS_CTE}, {tagged_cte('clicks', SIX_HOURS)}
        SELECT event_id, user_id, event_timestamp, event_type, path, session_index,
            {SESSION_ID} AS session_id FROM tagged""",
    "sessions_rollup": sessions(SIX_HOURS, "SELECT * FROM sessions"),
    "sessions_bucketed": sessions(SIX_HOURS, "SELECT * FROM sessions"),
    "sessions_half_hour": sessions(HALF_HOUR, "SELECT * FROM sessions"),
    "sessions_exact_gap": sessions(HALF_HOUR, "SELECT * FROM sessions", exact=True),
    "sessions_window_batch": sessions(
        HALF_HOUR,
        f"""SELECT user_id, start_ts, end_ts, duration_sec, num_events, num_pageviews, converted,
            end_ts + INTERVAL {HALF_HOUR} SECOND AS window_end FROM sessions""",
        exact=True,
    ),
    "one_day_pruned": sessions(
        SIX_HOURS,
        f"""SELECT user_id, start_ts, end_ts, duration_sec, num_events, converted, bounce
            FROM sessions WHERE event_date = {DAY}""",
    ),
    "layer_roundtrip": f"""
        WITH {RAW_CTE}, {SILVER_CTE}, {DIMS_CTE}
        SELECT *, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM ({ENRICHED})""",
    "sessions_day_by_day": landed("SELECT * FROM sessions"),
    "sessions_after_repair": landed("SELECT * FROM sessions"),
    "sessions_from_buckets": sessions(SIX_HOURS, "SELECT * FROM sessions"),
    "silver_second_load": f"""
        WITH {LANDED_CTE}, {SILVER_CTE}, {DIMS_CTE}
        SELECT *, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM ({ENRICHED})""",
    "span_users_sketched": sessions(
        SIX_HOURS,
        """, spans(since, until) AS (VALUES ('2024-01-03', '2024-01-03'), ('2024-01-08', '2024-01-14'),
            ('2024-01-01', '2024-01-31'))
        SELECT since, count(*) AS num_sessions, avg(duration_sec) AS avg_duration_sec,
            avg(CAST(bounce AS INT)) AS bounce_rate, avg(CAST(converted AS INT)) AS conversion_rate,
            true AS users_within_error
        FROM spans JOIN sessions ON event_date BETWEEN since AND until GROUP BY since""",
    ),
    "session_states_before": f"""
        WITH {CLICKS_CTE}, past AS (SELECT * FROM clicks WHERE CAST(event_timestamp AS DATE) < {DAY}),
        {tagged_cte('past', HALF_HOUR)}
        SELECT user_id, CAST(CAST(max(event_timestamp) AS DATE) AS VARCHAR) AS event_date,
            session_index AS sessions, count(*) AS num_events,
            count(*) FILTER (WHERE event_type = 'page_view') AS num_pageviews,
            count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
            first(path ORDER BY event_timestamp, path) AS entry_path, max(event_timestamp) AS end_ts
        FROM tagged GROUP BY user_id, session_index
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_index DESC) = 1""",
    "layer_survives_failure": f"""
        WITH {RAW_CTE}, {SILVER_CTE}, {DIMS_CTE}
        SELECT *, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM ({ENRICHED})""",
    "bronze_new_files": f"""
        WITH {LANDED_CTE}
        SELECT {FIELD_NAMES}, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM raw""",
    "bronze_day_files": f"""
        WITH {LANDED_CTE}
        SELECT count(*) AS rows_read, CAST(0 AS BIGINT) AS rows_elsewhere, true AS fewer_files
        FROM raw WHERE CAST(event_timestamp AS DATE) = {DAY}""",
    "bronze_file_removed": f"""
        WITH {LANDED_CTE}
        SELECT {FIELD_NAMES}, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM raw
        WHERE path <> '/product/1' OR event_type IS NOT NULL""",
    "landing_counts": f"""
        WITH {LANDED_CTE}
        SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date, count(*) AS rows
        FROM raw GROUP BY 1""",
    "landing_day_folders": f"""
        WITH {LANDED_CTE}
        SELECT coalesce(CAST(CAST(event_timestamp AS DATE) AS VARCHAR),
            '__HIVE_DEFAULT_PARTITION__') AS folder, count(*) AS rows FROM raw GROUP BY 1""",
    "bronze_typed": f"""
        WITH {LANDED_CTE}
        SELECT {FIELD_NAMES}, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM raw""",
    "bronze_bad_rows": f"""
        WITH {LANDED_CTE}
        SELECT count(*) AS lines,
            count(*) FILTER (WHERE path = '/product/4') AS corrupt_lines,
            count(*) FILTER (WHERE path = '/product/4') AS kept_texts,
            count(*) FILTER (WHERE path = '/product/3') AS bad_times FROM raw""",
    "silver_bots": f"""
        WITH {RAW_CTE}
        SELECT {IS_BOT} AS is_bot,
            count(*) AS events FROM raw GROUP BY 1""",
    "silver_clean": f"WITH {RAW_CTE}, {SILVER_CTE} SELECT * FROM silver",
    "silver_first_copy": f"""
        WITH {RAW_CTE}, {SILVER_CTE}
        SELECT {SILVER_COLUMNS} FROM silver
        QUALIFY row_number() OVER (
            PARTITION BY user_id, path ORDER BY event_timestamp, event_id) = 1""",
    "silver_enriched": f"WITH {RAW_CTE}, {SILVER_CTE}, {DIMS_CTE} {ENRICHED}",
    "star_enriched": f"""
        WITH {CLICKS_CTE}
        SELECT event_id, user_id, event_type, c_mktsegment, n_name, r_name
        FROM clicks LEFT JOIN customer ON user_id = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN region ON n_regionkey = r_regionkey""",
    "events_by_type": f"""
        WITH {CLICKS_CTE}
        SELECT event_type, count(*) AS events FROM clicks GROUP BY event_type""",
    "funnel": f"WITH {CLICKS_CTE}, {FUNNEL.format(source='clicks')}",
    "daily_sessions": sessions(SIX_HOURS, DAILY),
    "daily_sessions_unrounded": sessions(
        HALF_HOUR,
        """SELECT event_date, count(*) AS num_sessions, count(DISTINCT user_id) AS distinct_users,
            avg(duration_sec) AS avg_duration_sec, avg(CAST(bounce AS INT)) AS bounce_rate,
            avg(CAST(converted AS INT)) AS conversion_rate
            FROM sessions GROUP BY event_date ORDER BY event_date""",
    ),
    "top_paths": sessions(SIX_HOURS, TOP_PATHS),
    "sessions_per_user": sessions(
        SIX_HOURS, "SELECT user_id, count(*) AS sessions_per_user FROM sessions GROUP BY user_id"
    ),
    "returning_users": sessions(SIX_HOURS, RETURNING),
    "key_skew_report": f"{COUNTS} ORDER BY event_count DESC, user_id LIMIT 10",
    "hottest_user": f"{COUNTS} ORDER BY event_count DESC, user_id LIMIT 1",
    "hot_users": f"""
        SELECT user_id FROM ({COUNTS}) WHERE event_count > 70""",
    "heavy_users": f"""
        SELECT user_id, event_count FROM ({COUNTS})
        WHERE event_count * 140 > (SELECT count(*) FROM events)""",
    "top_users_sketched": f"{COUNTS} ORDER BY event_count DESC, user_id LIMIT 10",
    "naive_counts": COUNTS,
    "salted_counts": COUNTS,
    "hot_salted_counts": COUNTS,
    "skew_check": f"""
        SELECT CAST(sum(event_count) AS BIGINT) AS naive_total_events,
            CAST(sum(event_count) AS BIGINT) AS salted_total_events,
            CAST(0 AS BIGINT) AS differing_keys, 1 AS totals_match,
            max(event_count) AS hottest_user_events, 16 AS salt_factor FROM ({COUNTS})""",
    "salted_join": """
        SELECT event_id, user_id, c_name, c_mktsegment
        FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "batch_run": f"""
        WITH {LANDED_CTE}, {SILVER_CTE}, {tagged_cte('silver', HALF_HOUR)}, {SESSIONS_CTE}
        SELECT 'bronze' AS layer, count(*) AS rows FROM raw
        UNION ALL SELECT 'silver', count(*) FROM silver
        UNION ALL SELECT 'gold/key_skew_report', least(count(DISTINCT user_id), 10) FROM silver
        UNION ALL SELECT 'gold/skew_check', 1
        UNION ALL SELECT 'sessions', count(*) FROM sessions
        UNION ALL SELECT 'gold/funnel', 3
        UNION ALL SELECT 'gold/daily_sessions', count(DISTINCT event_date) FROM sessions
        UNION ALL SELECT 'gold/top_paths', least(count(DISTINCT entry_path), 15) FROM sessions
        UNION ALL SELECT 'gold/returning_users', 1""",
    "stream_sessions": stream(IDENTIFIED_CTE, "identified", "last_event"),
    "stream_sessions_window_end": stream(IDENTIFIED_CTE, "identified", "window"),
    "stream_sessions_clean": stream(SILVER_CTE, "silver", "last_event"),
    "stream_small_batches": stream(IDENTIFIED_CTE, "identified", "last_event", TWENTY_DAYS),
    "stream_restart": stream(IDENTIFIED_CTE, "identified", "last_event"),
    "stream_late_rows": stream(f"{IDENTIFIED_CTE}, {PUNCTUAL_CTE}", "punctual", "last_event"),
    "stream_late_repaired": stream(IDENTIFIED_CTE, "identified", "last_event"),
    "stream_numbered": f"""
        WITH {LANDED_CTE}, {IDENTIFIED_CTE}, {tagged_cte('identified', HALF_HOUR, exact=True)}, {SESSIONS_CTE}
        SELECT * FROM sessions WHERE end_ts + INTERVAL {HALF_HOUR} SECOND <= {CLOSED_BY}""",
    "stream_with_open_sessions": f"""
        WITH {LANDED_CTE}, {IDENTIFIED_CTE}, {tagged_cte('identified', HALF_HOUR, exact=True)}, {SESSIONS_CTE}
        SELECT user_id, start_ts, end_ts, num_events, num_pageviews, converted, entry_path, exit_path,
            end_ts + INTERVAL {HALF_HOUR} SECOND <= {CLOSED_BY} AS closed
        FROM sessions""",
    "batch_funnel": landed(f", {FUNNEL.format(source='silver')}"),
    "batch_daily_sessions": landed(DAILY),
    "batch_top_paths": landed(TOP_PATHS),
    "batch_returning_users": landed(RETURNING),
    "batch_bronze": f"""
        WITH {LANDED_CTE}
        SELECT {FIELD_NAMES}, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM raw""",
    "bronze_ingest": f"""
        WITH {LANDED_CTE}
        SELECT count(*) AS lines, count(*) AS ingested, CAST(1 AS BIGINT) AS loads FROM raw""",
    "silver_day_rebuilt": f"""
        WITH {LANDED_CTE}, {SILVER_CTE}, {DIMS_CTE}
        SELECT *, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date FROM ({ENRICHED})""",
}
