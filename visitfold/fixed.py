"""Values that decide results and therefore may not vary between deployments."""

# ---- Fixed values: names, word lists, lookup tables, defaults ---------------

LANDING_SCHEMA = (
    "event_id STRING, user_id STRING, event_timestamp STRING, event_type STRING, "
    "path STRING, referrer STRING, device STRING, country STRING, user_agent STRING"
)
LANDING_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

BOT_MARKERS = ["bot", "crawler", "spider", "python-requests", "ahrefs", "curl", "wget"]

EVENT_KEY = ["user_id", "event_timestamp", "event_type", "path"]

COUNTRY_VALUES = """
    ('US', 'United States', 'Americas'),
    ('CA', 'Canada', 'Americas'),
    ('BR', 'Brazil', 'Americas'),
    ('GB', 'United Kingdom', 'EMEA'),
    ('DE', 'Germany', 'EMEA'),
    ('FR', 'France', 'EMEA'),
    ('NG', 'Nigeria', 'EMEA'),
    ('IN', 'India', 'APAC'),
    ('JP', 'Japan', 'APAC'),
    ('AU', 'Australia', 'APAC')
"""
DEVICE_VALUES = """
    ('desktop', 'large_screen'),
    ('tablet', 'medium_screen'),
    ('mobile', 'small_screen')
"""

FUNNEL_STAGES = [
    ("1_view", "page_view"),
    ("2_add_to_cart", "add_to_cart"),
    ("3_purchase", "purchase"),
]

SESSION_GAP_SECONDS = 30 * 60
SALT_FACTOR = 16
HOT_KEY_THRESHOLD = 5000
TOP_PATHS = 15
TOP_KEYS = 10
