import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", app="shoplake-tests", shuffle_partitions=8)
    yield session
    session.stop()


def event(event_id="e1", event_type="page_view", ts="2026-09-10T10:00:00", session="s1", product=None,
          category=None, price=None, **extra):
    rec = {"event_id": event_id, "event_type": event_type, "user_id": "u1", "session_id": session,
           "timestamp": ts, "product_id": product, "category": category, "price": price,
           "device_type": "mobile", "referrer": "direct", "country": "US"}
    rec.update(extra)
    return rec


def edf(spark, rows, drop=()):
    """Event records -> DataFrame with the explicit event schema (plus any extra string fields)."""
    from pyspark.sql import types as T

    from shoplake.schema import EVENT_SCHEMA

    extra = sorted({k for r in rows for k in r} - set(EVENT_SCHEMA.fieldNames()))
    fields = [f for f in EVENT_SCHEMA.fields if f.name not in drop] + [T.StructField(k, T.StringType()) for k in extra]
    schema = T.StructType(fields)
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], schema)
