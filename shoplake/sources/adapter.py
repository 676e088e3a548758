"""Driver tables -> curated event frame.

The test data's ``events`` table has event_id, ts, user_id, event_type, value and props; it lacks the
session, product, category, device and country of a shop event. They are derived:

* session_id   = user_id + '-' + yyyyMMdd of ts (one session per user and day)
* event_type   = view -> product_view, click -> add_to_cart, signup -> checkout_start,
                 purchase -> purchase, error -> page_view
* product_id   = k % 40, category = the (k % 8)-th category, price = value; all null on page_view
* device_type  = the user's market segment, country = the user's nation (customer -> nation)

Join plan: no side is force-broadcast, because the sizes of ``customer`` and ``nation`` come from
files, not from code. The optimizer broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (adaptive execution re-checks with runtime sizes); the
tiny ``nation`` table always passes that check. ``customer`` grows with the data: beyond the
threshold the events join becomes a sort-merge join with skew splitting (a single user may own a
large share of all events).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.functions import iso_text
from shoplake.schema import CATEGORIES, CURATED_COLUMNS

# Event type names of the test data, mapped to shop event types.
DRIVER_EVENT_TYPES = {
    "view": "product_view",
    "click": "add_to_cart",
    "signup": "checkout_start",
    "purchase": "purchase",
}
DRIVER_FALLBACK_TYPE = "page_view"
PRODUCTS = 40
# Market segments of the customer table; they act as the device domain of the test data.
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id -> device_type, country (customer joined to nation)."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_custkey").alias("user_key"),
                    F.col("c_mktsegment").alias("device_type"),
                    F.col("n_name").alias("country")))


def shop_event_type(c: str = "event_type"):
    expr = F.lit(DRIVER_FALLBACK_TYPE)
    for src, dst in reversed(list(DRIVER_EVENT_TYPES.items())):
        expr = F.when(F.col(c) == src, F.lit(dst)).otherwise(expr)
    return expr


def conform_events(events: DataFrame, users: DataFrame, with_event_ts: bool = False) -> DataFrame:
    """Driver events + user dimension -> the curated columns (batch or streaming ``events``)."""
    has_product = F.col("event_type") != F.lit("error")
    k = F.get_json_object("props", "$.k").try_cast("int")
    categories = F.array(*[F.lit(c) for c in CATEGORIES])
    ts = F.col("ts").cast("timestamp_ntz")
    user = F.col("user_id").cast("string")
    # A left join: an event whose user is unknown keeps its row, without device and country.
    conformed = events.join(users, events.user_id == users.user_key, "left").select(
        F.col("event_id").cast("string").alias("event_id"),
        shop_event_type().alias("event_type"),
        user.alias("user_id"),
        F.concat(user, F.lit("-"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        iso_text(ts).alias("timestamp"),
        F.when(has_product, (k % PRODUCTS).cast("string")).alias("product_id"),
        F.when(has_product, F.element_at(categories, (k % len(CATEGORIES)) + 1)).alias("category"),
        F.when(has_product, F.col("value").cast("double")).alias("price"),
        F.col("device_type"),
        F.lit(None).cast("string").alias("referrer"),
        F.col("country"),
        F.lit(None).cast("string").alias("discount_code"),
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
        ts.alias("event_ts"),
    )
    cols = CURATED_COLUMNS + (["event_ts"] if with_event_ts else [])
    return conformed.select(*cols)


def curated_events(spark: SparkSession, sf_dir: str, with_event_ts: bool = False) -> DataFrame:
    """The 15 curated columns over the whole driver ``events`` table."""
    events = read_table(spark, sf_dir, "events")
    return conform_events(events, user_dimension(spark, sf_dir), with_event_ts)
