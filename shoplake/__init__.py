"""Event analytics on Spark: landing, ETL, analytics, data quality and streaming for shop events.

Every function takes and returns Spark DataFrames (or starts a StreamingQuery); nothing is
collected to the driver. Call ``configure(spark)`` once on a session you did not build here.
"""

from shoplake.operators.analytics import (  # noqa: F401
    abandoned_cart_products,
    event_type_counts,
    events_per_window,
    funnel_by_category,
    funnel_overall,
    revenue_by_country_device,
    revenue_pivot,
    revenue_trend,
    revenue_trend_dated,
    row_count,
    session_engagement,
    session_stats,
    union_zones,
)
from shoplake.operators.catalog import missing_partitions, refresh_table  # noqa: F401
from shoplake.operators.etl import etl, split_bad, to_curated  # noqa: F401
from shoplake.operators.landing import land_batch, land_files  # noqa: F401
from shoplake.session import build_session, configure  # noqa: F401
from shoplake.sources.raw import parse_events, read_curated, read_raw  # noqa: F401
from shoplake.sources.sinks import write_curated, write_result_csv  # noqa: F401

__version__ = "0.1.0"
