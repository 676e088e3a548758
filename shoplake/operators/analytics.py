"""Business questions over the curated event table (frame in, frame out).

Scale notes, per job:

* Group keys are either tiny (event type, country x device, day) or uniform and high-cardinality
  (session, (session, product)). Every aggregate here is decomposable, so Spark's partial
  aggregation collapses each key map-side before the shuffle; a hot session or user that holds a
  third of all rows turns into one partial row per task, not one huge task.
* Distinct counts are authored two-level (group by key and session, then sum flags) instead of
  ``count(DISTINCT ...)``, which would plan an Expand that multiplies the input rows.
* Carts without a purchase are found without a join: one aggregate per (session, product) carries a
  cart flag and a purchase flag, so the events are read and shuffled once and hot pairs collapse
  map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions import cents, event_time, money_mean, money_sum, pct, window_key, window_start
from shoplake.schema import DEVICE_TYPES, EVENT_COLUMNS, PAGE_LIKE_EVENTS


# The pivot's column for devices outside of its list.
OTHER = "other"


def _flag(event_type: str):
    """1 if the group has an event of the type, else 0 (also when event types are null)."""
    return F.max(F.when(F.col("event_type") == F.lit(event_type), F.lit(1)).otherwise(F.lit(0)))


def _session_flag(event_type: str):
    """As ``_flag``, but an event without a session counts for no session."""
    has = (F.col("event_type") == F.lit(event_type)) & F.col("session_id").isNotNull()
    return F.max(F.when(has, F.lit(1)).otherwise(F.lit(0)))


def event_type_counts(df: DataFrame) -> DataFrame:
    """``event_type, event_count``."""
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def funnel_by_category(df: DataFrame) -> DataFrame:
    """D2 + D4: distinct sessions per category that viewed / carted / bought, and step rates in %.

    The three stages are independent sets (no ordering is enforced), as in the source question. Events
    without a session count for none, but their category stays, with 0.
    """
    per_session = (
        df.where(F.col("category").isNotNull()).groupBy("category", "session_id")
        .agg(_session_flag("product_view").alias("v"), _session_flag("add_to_cart").alias("c"),
             _session_flag("purchase").alias("p"))
    )
    funnel = per_session.groupBy("category").agg(
        F.sum("v").cast("bigint").alias("viewed_sessions"),
        F.sum("c").cast("bigint").alias("added_to_cart_sessions"),
        F.sum("p").cast("bigint").alias("purchased_sessions"),
    )
    return funnel.select(
        "category", "viewed_sessions", "added_to_cart_sessions", "purchased_sessions",
        pct("added_to_cart_sessions", "viewed_sessions").alias("view_to_cart_pct"),
        pct("purchased_sessions", "added_to_cart_sessions").alias("cart_to_purchase_pct"),
        pct("purchased_sessions", "viewed_sessions").alias("view_to_purchase_pct"),
    ).orderBy(F.desc_nulls_last("viewed_sessions"), "category")


def funnel_overall(df: DataFrame) -> DataFrame:
    """D3: one row, distinct sessions per stage (view, cart, checkout, purchase)."""
    per_session = (
        df.where(F.col("session_id").isNotNull())
        .where(F.col("event_type").isin("product_view", "add_to_cart", "checkout_start", "purchase"))
        .groupBy("session_id")
        .agg(_flag("product_view").alias("v"), _flag("add_to_cart").alias("c"),
             _flag("checkout_start").alias("k"), _flag("purchase").alias("p"))
    )
    return per_session.agg(
        F.coalesce(F.sum("v"), F.lit(0)).cast("bigint").alias("viewed"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("added_to_cart"),
        F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("checkout_started"),
        F.coalesce(F.sum("p"), F.lit(0)).cast("bigint").alias("purchased"),
    )


def _purchases(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_type") == F.lit("purchase"))


def revenue_by_country_device(df: DataFrame) -> DataFrame:
    """``country, device_type, purchase_count, total_revenue, avg_order_value`` (exact cents)."""
    agg = _purchases(df).groupBy("country", "device_type").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        money_sum("price").alias("total_revenue"),
        F.sum(cents("price")).alias("_cents"),
        F.count("price").alias("_priced"),
    )
    return agg.select(
        "country", "device_type", "purchase_count", "total_revenue",
        money_mean("_cents", "_priced").alias("avg_order_value"),
    ).orderBy(F.desc_nulls_last("total_revenue"), "country", "device_type")


def session_stats(df: DataFrame) -> DataFrame:
    """``session_id, page_like_events, session_start, session_end``."""
    ts = event_time(df)
    return df.groupBy("session_id").agg(
        F.count(F.when(F.col("event_type").isin(*PAGE_LIKE_EVENTS), F.lit(1))).alias("page_like_events"),
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
    )


def session_engagement(df: DataFrame) -> DataFrame:
    """``total_sessions, avg_session_duration_seconds, avg_pages_per_session``."""
    stats = session_stats(df)
    duration = F.expr("timestampdiff(SECOND, session_start, session_end)")
    return stats.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.round(F.avg(duration), 1).alias("avg_session_duration_seconds"),
        F.round(F.avg("page_like_events"), 2).alias("avg_pages_per_session"),
    )


def revenue_trend(df: DataFrame) -> DataFrame:
    """``year, month, day, purchase_count, daily_revenue`` in date order (keys are partition columns)."""
    return (_purchases(df).groupBy("year", "month", "day")
            .agg(F.count(F.lit(1)).alias("purchase_count"), money_sum("price").alias("daily_revenue"))
            .orderBy("year", "month", "day"))


def revenue_trend_dated(df: DataFrame) -> DataFrame:
    """``date, daily_revenue`` with the date built from the zero-padded parts."""
    trend = _purchases(df).groupBy("year", "month", "day").agg(money_sum("price").alias("daily_revenue"))
    date = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    return trend.select(date.alias("date"), "daily_revenue").orderBy("date")


def row_count(df: DataFrame) -> DataFrame:
    """``event_count`` of the whole table."""
    return df.agg(F.count(F.lit(1)).alias("event_count"))


def revenue_pivot(df: DataFrame, devices: Sequence[str] = DEVICE_TYPES) -> DataFrame:
    """Revenue per country with one column per device and ``other``; empty cells are 0.

    The device list is passed, which fixes the output schema and spares the job that would collect
    the distinct pivot values to the driver. Revenue of any other device, or of none, is in
    ``other``, so a row's cells always sum up to the country's revenue.
    """
    listed = F.when(F.col("device_type").isin(*devices), F.col("device_type")).otherwise(F.lit(OTHER))
    return (_purchases(df).withColumn("device_type", listed).groupBy("country")
            .pivot("device_type", [*devices, OTHER]).agg(money_sum("price")).na.fill(0.0, subset=[*devices, OTHER]))


def abandoned_cart_products(df: DataFrame, n: int | None = 20) -> DataFrame:
    """C1 + C2 + D9 + D10 + F1: products added to a cart and not bought in the same session.

    One row per (session, product) with a cart and a purchase flag; a pair with a cart and no
    purchase is abandoned. A null session never matches a purchase, so its pair counts as abandoned
    whenever it has a cart. Top ``n`` by count, ties broken by product_id.
    """
    pairs = (df.where(F.col("product_id").isNotNull() & F.col("event_type").isin("add_to_cart", "purchase"))
             .groupBy("session_id", "product_id")
             .agg(_flag("add_to_cart").alias("cart"), _flag("purchase").alias("bought")))
    abandoned = pairs.where((F.col("cart") == 1) & ((F.col("bought") == 0) | F.col("session_id").isNull()))
    counted = abandoned.groupBy("product_id").agg(F.count(F.lit(1)).alias("abandoned_count"))
    ordered = counted.orderBy(F.desc("abandoned_count"), F.asc("product_id"))
    return ordered.limit(n) if n else ordered


def events_per_window(df: DataFrame, minutes: int = 5) -> DataFrame:
    """E1 + E2: events per hour-aligned N-minute window, ``window_start, window_key, event_count``."""
    start = window_start(event_time(df), minutes)
    return (df.select(start.alias("window_start"))
            .groupBy("window_start").agg(F.count(F.lit(1)).alias("event_count"))
            .select("window_start", window_key("window_start").alias("window_key"), "event_count")
            .orderBy("window_key"))


def union_zones(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """G1: batch-landed and stream-landed events as one frame of the 12 event columns.

    The stream side may lack ``discount_code``; missing columns become null.
    """
    def events_only(frame: DataFrame) -> DataFrame:
        return frame.select(*[c for c in EVENT_COLUMNS if c in frame.columns])
    return events_only(batch).unionByName(events_only(stream), allowMissingColumns=True).select(*EVENT_COLUMNS)
