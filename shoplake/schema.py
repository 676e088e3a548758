"""Data model: the raw event record, the curated table and the value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values. These must equal the event model's definitions for results to agree; they are
# stated here once, in their natural order.
# ---------------------------------------------------------------------------------------------
EVENT_TYPES = ["page_view", "product_view", "search", "add_to_cart", "checkout_start", "purchase"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
REFERRERS = ["google_organic", "google_ads", "direct", "email_campaign", "social_instagram",
             "social_facebook", "affiliate"]
COUNTRIES = ["US", "GB", "CA", "DE", "FR", "AU", "IN", "BR", "JP", "MX"]
CATEGORIES = ["electronics", "apparel", "home_goods", "beauty", "sporting_goods", "toys", "books",
              "grocery"]
# Funnel stages in order, and the designed conversion rate of each step from the stage before it.
FUNNEL_STAGES = ["page_view", "product_view", "add_to_cart", "checkout_start", "purchase"]
STAGE_RATES = [("page_view", "product_view", 0.40), ("product_view", "add_to_cart", 0.375),
               ("add_to_cart", "checkout_start", 0.667), ("checkout_start", "purchase", 0.70)]
# Bounds of the page_view -> purchase rate, exclusive.
PURCHASE_RATE_BOUNDS = (0.02, 0.15)
# Event types that carry no product; all others carry one.
NO_PRODUCT_EVENTS = ["page_view", "search"]
# Event types counted as "pages" in session engagement.
PAGE_LIKE_EVENTS = ["page_view", "product_view"]
# End of fixed values.

RAW_FIELDS = [
    ("event_id", T.StringType()),
    ("event_type", T.StringType()),
    ("user_id", T.StringType()),
    ("session_id", T.StringType()),
    ("timestamp", T.StringType()),
    ("product_id", T.StringType()),
    ("category", T.StringType()),
    ("price", T.DoubleType()),
    ("device_type", T.StringType()),
    ("referrer", T.StringType()),
    ("country", T.StringType()),
    ("discount_code", T.StringType()),
]
EVENT_COLUMNS = [name for name, _ in RAW_FIELDS]
EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])

CORRUPT_COLUMN = "_corrupt_record"
# Explicit read schema of the raw zone: no inference pass, evolving keys become null columns.
RAW_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])

RAW_PARTITIONS = ["year", "month", "day", "hour"]
CURATED_PARTITIONS = ["year", "month", "day"]
CURATED_COLUMNS = EVENT_COLUMNS + CURATED_PARTITIONS

# Quarantine reasons, in the order they are tested.
ERROR_TYPES = ["malformed_json", "missing_event_id", "missing_timestamp", "unparseable_timestamp"]
